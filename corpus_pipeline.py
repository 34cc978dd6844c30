"""A corpus from documents to packed sequences: five stages, each on what the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a table; it is written as Parquet in the
shared folder and read again as the next one's ``docs``, so a lost executor repeats one stage at
most. All stages but the last return the columns of ``docs``, extra ones included.

Null texts count as empty texts. Rows that repeat whole are copies of each other: one stays. Rows
that share an id with different texts are kept or dropped together by the near-duplicate stage.
An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import exact_dedup, jaccard, mixing, packing, toxicity
from barloom.llm.common import text_or_empty
from barloom.llm.queries import BYTE_BPE, table
from barloom.sinks.writers import written


def _joined(docs: DataFrame, decided: DataFrame, keys: dict[str, object], how: str) -> DataFrame:
    """Join on computed keys (null-safe); names of ``docs`` may be anything.

    The decisions are the narrow side: hashing them spares the sort of the texts.
    """
    sides = decided.toDF(*[f"__decided_{c}" for c in decided.columns]).hint("shuffle_hash")
    on = [value.eqNullSafe(F.col(f"__decided_{name}")) for name, value in keys.items()]
    return docs.join(sides, on, how)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(toxicity.training_sample(docs, labels, "toxic", 4, 2), docs)
    return docs.where(model.score("text") < toxicity.THRESHOLD)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of equal texts."""
    decided = written(exact_dedup.exact_duplicates(docs), "corpus-copies")
    digest = F.sha2(text_or_empty(), 256)
    keys = {"doc_id": docs["doc_id"].cast("bigint"), "text_sha256": digest}
    stays = decided.where("kept").select("doc_id", "text_sha256")
    kept = _joined(docs, stays, keys, "left_semi")
    # Only rows that repeat whole share the id that stays; where there are none, nothing is left.
    repeats = decided.where("NOT kept AND doc_id <=> keep_id")
    return kept if repeats.isEmpty() else kept.dropDuplicates(["doc_id", "text"])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates."""
    found = jaccard.similar_documents(docs)
    stays = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id")
    return _joined(docs, stays, {"doc_id": docs["doc_id"].cast("bigint")}, "left_semi")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    times = written(
        mixing.mix_sources(docs)
        .where("taken > 0")
        .groupBy("doc_id", "text_hash")
        .agg(
            F.sum(F.col("taken") / F.col("size")).cast("int").alias("times"),
            F.count(F.lit(1)).alias("rows"),
        ),
        "corpus-times",
    )
    once = docs if times.where("rows > 1").isEmpty() else docs.dropDuplicates(["doc_id", "text"])
    keys = {"doc_id": once["doc_id"].cast("bigint"), "text_hash": F.xxhash64(text_or_empty())}
    taken = _joined(once, times, keys, "inner")
    repeated = taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__decided_times"))))
    return repeated.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    return packing.pack_documents(docs, BYTE_BPE)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: SQL has neither the models nor the tokenizer of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
