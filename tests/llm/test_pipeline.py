import corpus_pipeline
import __spark_entry__ as entry


def test_stages_run_one_after_the_other(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.written(stage(spark, docs, folder), "stage")
        assert kept.columns == docs.columns and 0 < kept.count() <= before, name
        assert kept.join(docs, "doc_id", "left_anti").count() == 0
        docs, before = kept, kept.count()
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert mixed.columns == [*docs.columns, "copy"] and 0 < mixed.count() <= 3 * before


def test_an_empty_table_passes_through(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{source}/{name}.parquet").limit(0).write.parquet(f"file://{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
