"""The registered queries: contracts, SQL, and the pipeline against the operators."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))
from oracle_check import rows_of  # noqa: E402

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
COLUMNS = {
    "op1_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op2_personal_data": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint",
                          "base_sha256": "string", "spans": "string"},
    "op3_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op4_topk": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op5_suffix_array_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op6_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op7_language_model": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint",
                           "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op8_decontamination": {"doc_id": "bigint", "item_id": "bigint"},
    "op9_url_filters": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op10_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint",
                     "sequence_id": "bigint", "offset": "bigint"},
    "op11_license_scans": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint",
                           "base_labels": "string", "labels": "string", "score": "double"},
    "op12_conversation_trie": {"conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint",
                               "n_children": "bigint", "n_leaves": "bigint", "saved_tokens": "bigint", "ends_sha256": "string"},
    "op13_conversation_repair": {"conv_id": "bigint", **dict.fromkeys(["gaps", "blank", "duplicate", "truncated", "illegal", "cost"], "bigint"),
                                 "audit": "string", "repaired_sha256": "string"},
}


@pytest.mark.parametrize("name", COLUMNS)
def test_contract_columns(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    kinds = dict(df.dtypes)
    assert {c: kinds.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    if name not in ("op4_topk", "op8_decontamination", "op10_packing", "op12_conversation_trie", "op13_conversation_repair"):  # a row for each row of the table
        source = spark.read.parquet(f"{SF_SMALL}/{'pages' if name.startswith('op9') else 'documents'}.parquet")
        ids = lambda x: sorted(r[0] for r in x.select(x.columns[0]).collect())
        assert ids(df) == ids(source)


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n.startswith("op")))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = entry.queries()[name](spark, SF_SMALL)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == rows_of(rel.fetchall(), rel.columns)


def test_pipeline_stages(spark):
    """Each stage keeps the columns of documents, its decision takes effect, and what the last
    packs are the documents that the others kept."""
    import corpus_pipeline
    from dimweave.llm import decontamination, jaccard, packing, toxicity

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("score", F.lit(7))
    docs = docs.union(docs.limit(3)).cache()
    kept, stages = docs, dict(corpus_pipeline.STAGES)
    after = {}
    for name in list(stages)[:-1]:
        kept = stages[name](spark, kept, SF_SMALL).cache()
        assert kept.columns == docs.columns
        after[name] = kept
    model = toxicity.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    clean = toxicity.score(docs, model, keep=["doc_id"]).filter("predicted = 0")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert ids(after["toxicity"]) == ids(clean)
    groups = jaccard.similar_documents(after["toxicity"])
    assert ids(after["ngram_jaccard"]) == sorted({r.component_id for r in groups.collect()})
    leaks = {r.doc_id for r in decontamination.find_leaks(after["ngram_jaccard"], spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).collect()}
    assert ids(after["decontamination"]) == [i for i in ids(after["ngram_jaccard"]) if i not in leaks]
    assert ids(after["personal_data"]) == ids(after["decontamination"])
    assert after["personal_data"].filter(F.col("text").rlike("[A-Za-z0-9]@[A-Za-z0-9-]+[.][A-Za-z]")).count() == 0
    assert after["personal_data"].filter(F.length("text") != F.col("n_chars")).count() == 0
    pieces = stages["packing"](spark, kept, SF_SMALL)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == set(ids(kept))
    assert pieces.count() == packing.pack_sequences(kept).count()


def test_pipeline_of_no_documents(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0


def test_pipeline_query(spark):
    out = entry.queries()["pipeline"](spark, SF_SMALL)
    assert out.count() > 0 and "sequence_id" in out.columns
