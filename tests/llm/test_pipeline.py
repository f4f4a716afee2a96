"""The pipeline's stages one after the other, on the smallest tables."""

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.columns == columns, name
        if name != "mixing sources":
            assert out.select("doc_id").distinct().count() == out.count() <= before
        docs, before = out, out.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert last.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def good_text():
    import pyarrow.parquet as pq

    good = {r["doc_id"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist() if r["quality"] == 1 and not r["toxic"]}
    texts = sorted((r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist() if r["doc_id"] in good)
    return next(t for _, t in texts if 200 < len(t.split()) < 400)


GOOD = good_text()
ODD = [(1, GOOD, "en", "a", len(GOOD)), (2, GOOD + " Almost the same.", "en", None, 0), (1, GOOD, "en", "a", len(GOOD)),
       (3, None, None, "b", None), (4, "", "", "", 0), (None, "x " + GOOD, None, None, None),
       (None, None, None, None, None), (5, "### $$$ " * 60, "xx", "b", 1), (6, "word " * 50_000, "en", "c", 1), (7, "\n\n \n", "en", "a", 4)]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_take_odd_rows(spark):
    docs = spark.createDataFrame(ODD, COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert {r["doc_id"] for r in out.collect()} <= {r[0] for r in ODD}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    pieces = packed.groupBy("doc_id").sum("length").collect()
    assert {r["doc_id"] for r in pieces} == {r[0] for r in ODD}
    kept = corpus_pipeline.quality_rules(spark, docs, SF).collect()
    assert 1 in {r["doc_id"] for r in kept} and not {3, 4, 5, 6, 7} & {r["doc_id"] for r in kept}
    assert sorted(r["doc_id"] or 0 for r in corpus_pipeline.near_duplicates(spark, docs.where("doc_id <= 2"), SF).collect())[0] == 1


def test_stages_take_an_empty_table(spark):
    docs = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_the_pipeline_leaves_one_table_behind(spark):
    from pathlib import Path

    from kerbside.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    result = corpus_pipeline.run(spark, SF)
    assert result.count() > 0 and result.columns[:2] == ["doc_id", "start"]
    assert Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")).exists()
