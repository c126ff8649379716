from pyspark.sql import functions as F

import corpus_pipeline
from headway.llm import queries


def test_stages_in_order(spark, small, tmp_path):
    docs, sf_dir = small, "/root/testdata/sf0.001"
    ids = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        columns = docs.columns
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids
        ids = now
        if name != "packing":
            assert docs.columns == columns
    assert corpus_pipeline.run(spark, sf_dir).count() == docs.count() > 0


def test_stages_take_odd_and_empty_tables(spark, odd, empty):
    plain = ["doc_id", "text", "lang", "source", "n_chars"]
    for frame in (odd.select(plain), empty.select(plain)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, frame, "/root/testdata/sf0.001").count()


CLASHES = ("n_words word_chars n_symbols n_dup_lines n_lines n_repeat_words base_failed kept n_dropped stratum component_id "
           "fingerprint h first hash node row key").split()


def test_clashing_columns_come_back(spark, small):
    docs = small.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASHES})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[c] == f"{c}{r.doc_id}" for r in rows for c in CLASHES), name
        plain = stage(spark, small, "/root/testdata/sf0.001")
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in plain.collect())
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").count() > 0


def test_rows_of_one_id_are_judged_by_their_own_text(spark, small, tmp_path):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    leak = benchmark.orderBy(F.desc(F.length("text"))).first().text
    clean = [r.text for r in small.filter("lang = 'en' and n_chars > 600").orderBy("doc_id").limit(2).collect()]
    rows = [(None, leak), (None, clean[0]), (7, leak), (7, clean[1]), (8, leak)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], small.schema)
    kept = corpus_pipeline.decontamination(spark, docs, "/root/testdata/sf0.001").collect()
    assert {(r.doc_id, r.text) for r in kept} == {rows[1], rows[3]}


def test_thirteen_queries():
    assert {q.split("_")[0] for q in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
