"""From raw documents to packed training sequences, in five stages of the llm operators.

Each stage takes (spark, docs, sf_dir) and returns what is left of ``docs``, with its columns;
the last returns the packed pieces.  ``run`` writes every stage's rows as Parquet in the shared
folder (``spark.checkpoint.dir``) and reads them again for the next.

A stage judges all rows that its predecessor kept.  Extra columns pass through, also where they
are named like a result of an operator; null and empty texts stay (they are neither toxic nor
alike nor leaked, and pack as an end token); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.llm import decontamination, jaccard, packing, sanitise, toxicity
from dimweave.session import work_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    own = [f"_p{i}" for i in range(len(docs.columns))]  # a column may be named like a result
    judged = toxicity.score(docs.toDF(*own), model, text=own[docs.columns.index("text")], evidence=False)
    return judged.filter("predicted = 0").select(*(F.col(o).alias(c) for o, c in zip(own, docs.columns)))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the one with the smallest id; rows that repeat id
    and text count as one.  Documents without an id can't be named: those that only link with
    each other stay, one for each text."""
    groups = jaccard.similar_documents(docs)
    first = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_p_id")).distinct()
    kept = docs.join(first, docs["doc_id"].cast("long").eqNullSafe(F.col("_p_id")), "left_semi")
    return kept.dropDuplicates(["doc_id", "text"]).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; under a null or repeated id each text is judged by
    itself."""
    leaks = decontamination.find_leaks(docs, _table(spark, sf_dir, "benchmark"))
    found = leaks.select(F.col("doc_id").alias("_p_id"), F.col("text_hash").alias("_p_hash")).distinct()
    own = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(found, docs["doc_id"].eqNullSafe(F.col("_p_id")) & (own == F.col("_p_hash")), "left_anti")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data masked; n_chars follows the new text."""
    clean = sanitise.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences: one row for each piece."""
    return packing.pack_sequences(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", keep_one_of_each_group),
    ("decontamination", drop_benchmark_leaks),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]
#: Classifying, connected components and tokenising have no SQL; see tests/llm for the checks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
