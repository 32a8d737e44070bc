"""Registered queries: names, digests, the pipeline against its stages done by hand."""

import hashlib

import pytest

import __spark_entry__ as E
import corpus_pipeline
from tamarind.llm import queries
from tamarind.queries.compare import compare, duck


def test_every_operator_has_one_query():
    names = [n.split("_")[0] for n in queries.QUERIES if n.startswith("op")]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{i}" for i in range(1, 14)] and "pipeline" in queries.QUERIES
    assert set(queries.ORACLES) <= set(queries.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, sf_dir, name):
    res = compare(queries.QUERIES[name](spark, sf_dir), queries.ORACLES[name], sf_dir, duck(sf_dir))
    assert res["ok"], res


def test_bpe_digests(spark, sf_dir):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(queries.BPE_FILE)
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op3_bpe(spark, sf_dir).collect():
        ids = library.encode(text[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("name", ["op1_near_duplicates", "op2_quality", "op4_language_id", "op9_license_scan", "op10_toxicity"])
def test_one_row_per_document(spark, sf_dir, name):
    ids = sorted(r.doc_id for r in queries.QUERIES[name](spark, sf_dir).collect())
    assert ids == sorted(r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect())


def test_pipeline_keeps_what_each_operator_keeps(spark, sf_dir):
    """Each stage by hand, in Python, on what the one before kept."""
    from tamarind.llm import bag_minhash, decontaminate, language_id, toxicity
    from tamarind.llm.common import crc_mod
    from pyspark.sql import functions as F
    from tests.llm.test_bag_minhash import brute as classes
    from tests.llm.test_text_scans import brute as leaks

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learn = crc_mod(F.col("doc_id"), 4) != 2
    seen = {r.doc_id: r for r in language_id.identify(docs, language_id.learn(docs, corpus_pipeline.PIECES_FILE, learn)).collect()}
    kept = [i for i, r in seen.items() if r.lang_pred != "und" and r.score >= 0.5]
    left = docs.where(F.col("doc_id").isin(kept))
    machine = toxicity.learn(left, spark.read.parquet(f"{sf_dir}/labels.parquet"), learn)
    kept = {r.doc_id: r.text for r in toxicity.score(left, machine).collect() if r.score < 0.3}
    kept = {i: kept[i] for i in set(classes(sorted(kept.items())).values())}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = {i for i, x in leaks(sorted(kept.items()), items).items() if not x[1]}
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == [*docs.columns, "token_ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = out.collect()
    assert {r.doc_id for r in rows} == kept and len(rows) == len(kept)
    assert all(r.n_tokens == len(r.token_ids) and r.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest() for r in rows)


def test_stages_on_odd_rows(spark, sf_dir, odd_docs):
    columns = odd_docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd_docs, sf_dir)
        assert out.columns[:len(columns)] == columns if name != "bpe" else set(["doc_id", "text", "lang"]) <= set(out.columns)
        kept[name] = sorted(str(r.doc_id) for r in out.select("doc_id").collect())
        assert stage(spark, odd_docs.limit(0), sf_dir).collect() == []
    assert "3" not in kept["language"] and "9" not in kept["language"] and kept["language"].count("1") == 2
    assert len(kept["decontamination"]) == len(kept["bpe"]) == odd_docs.count()
