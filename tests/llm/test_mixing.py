from pyspark.sql import functions as F

from lakesearch.llm.mixing import mixed, mixing_stage

SCHEMA = "doc_id long, text string, source string"


def test_targets_caps_and_copies(spark):
    rows = [(i, "w " * (1 + i % 50), "abc"[i % 3] if i % 10 else None) for i in range(3000)]
    found = mixed(spark.createDataFrame(rows, SCHEMA).repartition(7)).cache()
    per = {r["source"]: r for r in found.groupBy("source").agg(F.sum("size").alias("z"), F.sum("taken").alias("k"), F.first("target").alias("t"), F.first("source_size").alias("s")).collect()}
    total = sum(r["z"] for r in per.values())
    assert abs(sum(r["t"] for r in per.values()) - total) < 1e-6 * total
    assert all(r["s"] == r["z"] and r["t"] <= 3 * r["z"] and abs(r["k"] - r["t"]) < 200 for r in per.values())
    assert found.where("copies not between 0 and 3 or taken <> copies * size").count() == 0
    weights = {"a": 5, "b": 2, "c": 1, None: 5}
    free = {s: r["t"] / weights[s] for s, r in per.items() if r["t"] < 3 * r["z"]}
    assert max(free.values()) - min(free.values()) < 1e-6 * total


def test_same_mix_in_any_partitioning(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 9), f"s{i % 4}") for i in range(500)], SCHEMA)
    one, two = (sorted((r["doc_id"], r["taken"]) for r in mixed(d).collect()) for d in (docs.coalesce(1), docs.repartition(9, "text")))
    assert one == two


def test_edge_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x", None), (None, "x y", None), (None, "x y", None), (4, "z " * 100_000, "b"), (4, "z " * 100_000, "b")]
    docs = spark.createDataFrame([(*r, 1, 2.0, "t") for r in rows], f"{SCHEMA}, Size int, TARGET double, taken string")
    found = mixed(docs)
    assert found.columns == ["doc_id", "text", "source", "size", "source_size", "target", "copies", "taken"]
    got = found.collect()
    assert len(got) == 7 and {r["target"] for r in got if r["source"] == "a"} == {0.0}
    assert {r["size"] for r in got if r["doc_id"] in (1, 2)} == {0}
    assert mixed(spark.createDataFrame([], SCHEMA)).count() == 0
    nothing = mixed(spark.createDataFrame([(1, None, "a"), (2, "", None)], SCHEMA)).collect()
    assert [(r["target"], r["taken"]) for r in nothing] == [(0.0, 0), (0.0, 0)]


def test_stage_repeats_documents(spark):
    docs = spark.createDataFrame([(i, "w " * 5, "a" if i < 4 else "b") for i in range(40)], SCHEMA)
    found = mixing_stage(spark, docs, "")
    assert found.columns == ["doc_id", "text", "source", "copy"]
    taken = {r["doc_id"]: r["copies"] for r in mixed(docs).collect()}
    assert {r["doc_id"]: r["count"] for r in found.groupBy("doc_id").count().collect()} == {k: n for k, n in taken.items() if n}


def test_stage_replaces_a_copy_column(spark, tmp_path):
    docs = spark.createDataFrame([(i, "w " * 5, "a", "x") for i in range(9)], f"{SCHEMA}, Copy string")
    mixing_stage(spark, docs, "").write.parquet(f"{tmp_path}/mix")
    found = spark.read.parquet(f"{tmp_path}/mix")
    assert found.columns == ["doc_id", "text", "source", "copy"] and {r["copy"] for r in found.collect()} <= {1, 2, 3}


def test_no_python_in_the_plan(spark):
    plan = mixed(spark.createDataFrame([(1, "a", "s")], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
