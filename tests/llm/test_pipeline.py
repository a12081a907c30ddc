import corpus_pipeline as P
from quarry.llm import bpe


def test_stages_keep_the_columns_and_act(spark, docs, sf):
    d = docs
    counts = [d.count()]
    for _, stage in P.STAGES[:-1]:
        d = stage(spark, d, sf)
        assert d.schema == docs.schema
        counts.append(d.count())
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[4] > 0.5 * counts[0]
    assert d.where("n_chars <> length(text)").count() == 0
    rows = P.STAGES[-1][1](spark, d, sf)
    assert rows.count() == counts[4] and rows.where("not round_trip").count() == 0
    texts = {r.doc_id: r.text for r in bpe.decode(rows).collect()}
    assert texts == {r.doc_id: r.text for r in d.collect()}


def test_run_is_the_stages_one_after_another(spark, docs, sf):
    d = docs
    for _, stage in P.STAGES:
        d = stage(spark, d, sf)
    rows = lambda x: sorted((r.doc_id, tuple(r.token_ids)) for r in x.collect())
    assert rows(P.run(spark, sf)) == rows(d) and 4 <= len(P.STAGES) <= 5


def test_run_over_odd_and_empty_tables(spark, odd, empty, labels, tmp_path):
    for name, df in (("odd", odd), ("empty", empty)):
        d = tmp_path / name
        df.write.parquet(f"{d}/documents.parquet")
        labels.write.parquet(f"{d}/labels.parquet")
        spark.createDataFrame([(1, "one two three four five six seven eight nine")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        got = P.run(spark, str(d))
        assert got.where("not round_trip").count() == 0 and (got.count() > 5) == (name == "odd")
