import hashlib

from pyspark.sql import functions as F

from lakesearch.llm.exact import EXACT_SQL, collect_state, deduplicated, exact_copies

SCHEMA = "doc_id long, text string, kept string"


def expected(rows):
    """By plain dictionaries: ``doc_id, keep_id, group_size, text_sha256`` of every row, and how many rows of each text stay."""
    groups = {}
    for key, text, _ in rows:
        groups.setdefault(text or "", []).append(key)
    best = {t: max((k for k in ks if k is not None), default=None) for t, ks in groups.items()}
    return sorted(((k, best[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for k, t, _ in rows), key=str), len(groups)


ROWS = [(1, "same"), (2, "same"), (2, "same"), (3, None), (4, ""), (None, "same"), (None, "lone"), (None, "lone"), (5, "Same"), (6, "x" * 300_000), (7, "x" * 300_000), (8, "é"), (9, "é")]
ROWS = [(k, t, "old") for k, t in ROWS]


def found(df):
    out = df.collect()
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out), key=str), sum(r["kept"] for r in out)


def write(spark, rows, folder, files=1):
    spark.createDataFrame(rows, SCHEMA).repartition(files).write.mode("append").parquet(folder)
    return folder


def test_against_dictionaries(spark, tmp_path):
    folder = write(spark, ROWS, f"file://{tmp_path}/documents.parquet", 3)
    df = deduplicated(spark, folder)
    assert df.columns == ["doc_id", "text", "keep_id", "group_size", "kept", "text_sha256"]
    assert found(df) == expected(ROWS)
    stays = {(r["doc_id"], r["text"]) for r in df.where("kept").collect()}
    assert {(2, "same"), (4, ""), (7, "x" * 300_000), (None, "lone")} <= stays and (1, "same") not in stays


def test_colliding_digests_are_told_apart_by_their_bytes(spark, tmp_path):
    folder = write(spark, ROWS, f"file://{tmp_path}/documents.parquet", 2)
    for digest in (lambda text: F.lit(b"one"), lambda text: F.encode(F.lower(text), "UTF-8")):
        assert found(deduplicated(spark, folder, digest=digest)) == expected(ROWS)


def test_state_goes_on_over_batches_and_restarts(spark, tmp_path):
    folder, state = f"file://{tmp_path}/documents.parquet", f"file://{tmp_path}/state"
    write(spark, ROWS, folder, 4)
    assert found(deduplicated(spark, folder, state=state, bytes_per_batch=1)) == expected(ROWS)
    batches = [p.name for p in (tmp_path / "state/changed").iterdir() if p.name.startswith("batch=")]
    assert len(batches) == 5  # one for each file, and the empty one
    more = [(50, "same", "new"), (0, "lone", "new"), (51, "fresh", "new")]
    write(spark, more, folder)
    assert found(deduplicated(spark, folder, state=state)) == expected(ROWS + more)
    assert len([p for p in (tmp_path / "state/changed").iterdir() if p.name.startswith("batch=")]) == 6
    schema = spark.read.parquet(folder).schema
    held = collect_state(spark, folder, schema, "doc_id", "text", state).collect()
    assert len(held) == len({t or "" for _, t, _ in ROWS + more}) and "_text" not in held[0].asDict()


def test_empty_table(spark, tmp_path):
    folder = write(spark, [], f"file://{tmp_path}/documents.parquet")
    assert deduplicated(spark, folder).count() == 0


def test_query_equals_its_sql(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS FROM '{folder}/documents.parquet'")
    sql = duckdb.sql(EXACT_SQL).fetchall()
    assert sorted(tuple(r) for r in exact_copies(spark, folder).collect()) == sorted(sql)
