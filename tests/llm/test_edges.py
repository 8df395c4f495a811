"""Every operator and stage on nulls, odd texts, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from filingspark.llm import licenses, mixing, queries
from filingspark.llm.decontaminate import contaminated
from filingspark.llm.exact_dedup import exact_dedup
from filingspark.llm.hmm import lm_scores
from filingspark.llm.language_id import language_id
from filingspark.llm.pii import pii_digest
from filingspark.llm.simhash import simhash_components
from filingspark.llm.token_counts import token_counts
from filingspark.llm.toxicity import toxicity


def labels(spark, ids):
    return spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in ids] + [(None, None, None), (1, 0, None), (3, 1, 7)], "doc_id long, quality int, toxic int")


def benchmark(spark):
    return spark.createDataFrame([(1, "repeated row of text"), (2, None), (3, ""), (None, "an item without an id here"), (1, "repeated row of text")], "item_id long, text string")


def mixed(spark, docs):
    docs = docs.select("doc_id", queries.domain(F.col("source")).alias("domain"), "lang", "source", "text", "fp", "n_chars")
    return mixing.mix(docs, queries.weights(spark), fraction=0.7)


ROWWISE = {
    "language_id": lambda s, d: language_id(d, 20),
    "toxicity": lambda s, d: toxicity(d, labels(s, range(60)), 20),
    "exact_dedup": lambda s, d: exact_dedup(d),
    "lm_scores": lambda s, d: lm_scores(d, states=2, rounds=1, own=20, hashed=10, held=30),
    "pii": lambda s, d: pii_digest(d, 50),
    "licenses": lambda s, d: licenses.license_scan(d),
    "token_counts": lambda s, d: token_counts(d, queries.tokenizer_path()),
    "simhash": lambda s, d: simhash_components(d),
}


@pytest.mark.parametrize("name", ROWWISE)
def test_each_row_comes_back(spark, edge_docs, no_docs, edge_rows, name):
    out = ROWWISE[name](spark, edge_docs).collect()
    assert sorted(r.doc_id for r in out if r.doc_id is not None) == sorted(r[0] for r in edge_rows if r[0] is not None)
    assert len(out) == len(edge_rows)
    assert ROWWISE[name](spark, no_docs).collect() == []


def test_decontamination_edges(spark, edge_docs, no_docs):
    found = contaminated(edge_docs, benchmark(spark)).collect()
    assert [(r.doc_id, r.item_id, r.similarity) for r in found] == [(203, 1, 1.0)] * 3
    assert contaminated(no_docs, benchmark(spark)).collect() == []
    assert contaminated(edge_docs, benchmark(spark).limit(0)).collect() == []


def test_mixing_edges(spark, edge_docs, no_docs):
    out = mixed(spark, edge_docs).collect()
    assert out and all(0 < r.taken <= r.n_tokens for r in out)
    assert mixed(spark, no_docs).collect() == []


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_columns(spark, edge_docs, no_docs, tmp_path, name, stage):
    benchmark(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    out = stage(spark, edge_docs, str(tmp_path))
    assert out.columns == edge_docs.columns
    rows = out.collect()
    assert 0 < len(rows) <= edge_docs.count()
    assert stage(spark, no_docs, str(tmp_path)).collect() == []
    ids = [r.doc_id for r in rows]
    if name == "exact_dedup":
        assert ids.count(203) == 1 and 200 not in ids and ids.count(204) == 2
    if name == "decontamination":
        assert 203 not in ids
    if name == "language_id":
        assert not {100, 101, 102, 103} & set(ids)
        assert set(range(80)) <= set(ids)



@pytest.mark.parametrize("name", ROWWISE)
def test_invalid_bytes(spark, name):
    rows = [(i, bytearray(b"the market \xff\xfe and trading report \xc3( shows growth, see a@b.example.com " * 3), "en", "src1") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, raw binary, lang string, source string").select("doc_id", F.expr("cast(raw as string)").alias("text"), "lang", "source")
    assert sorted(r.doc_id for r in ROWWISE[name](spark, docs).collect()) == list(range(6))


def test_invalid_bytes_in_stages(spark, tmp_path):
    raw = b"repeated row of text \xff \xc3( with more words that follow it here " * 20
    docs = spark.createDataFrame([(1, bytearray(raw), "en", "src1"), (2, bytearray(b"\xff\xfe"), None, None)], "doc_id long, raw binary, lang string, source string")
    docs = docs.select("doc_id", F.expr("cast(raw as string)").alias("text"), "lang", "source")
    benchmark(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() <= 2 or name == "mixing"
    assert contaminated(docs, benchmark(spark)).select("doc_id", "item_id").collect() == [(1, 1)]


def test_items_of_any_id_type_and_clashing_columns(spark, edge_docs):
    items = benchmark(spark).select(F.col("item_id").cast("decimal(10,0)").alias("item_id"), "text", F.lit(1).alias("found"), F.lit("x").alias("doc_id"))
    assert [(r.doc_id, int(r.item_id)) for r in contaminated(edge_docs, items).collect()] == [(203, 1)] * 3
