"""The near-duplicate stage keeps its rows when Spark deals the same files to other partitions halfway."""

import corpus_pipeline


def test_places_outlive_another_dealing_of_the_files(spark, tmp_path, monkeypatch):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30)), "en", "s", 1) for i in range(60)]
    path = f"file://{tmp_path}/documents"
    spark.createDataFrame(rows, "doc_id int, text string, lang string, source string, n_chars long").repartition(6).write.parquet(path)
    name = "spark.sql.leafNodeDefaultParallelism"
    found = corpus_pipeline.simhash.near_duplicates

    def then_fewer_cores(*args, **options):
        out = found(*args, **options)
        spark.conf.set(name, "2")
        return out

    monkeypatch.setattr(corpus_pipeline.simhash, "near_duplicates", then_fewer_cores)
    spark.conf.set(name, "6")
    try:
        kept = corpus_pipeline.near_duplicates(spark, spark.read.parquet(path), "")
        assert sorted(r["doc_id"] for r in kept.collect()) == list(range(60))
    finally:
        spark.conf.unset(name)
