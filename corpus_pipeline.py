"""Documents to training sequences in five stages, each written before the next reads it.

All stages but the last return the columns of ``documents``, and each works on what the one before
kept. Rows may repeat and ids may be null; a row's identity is its id and its text. Further columns of ``documents``,
whatever their names, pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.common import table, written
from wardline.llm.decontaminate import contaminated_spans, is_contaminated, n_hit
from wardline.llm.hyperminhash import similar_groups
from wardline.llm.language_id import fit, recognised
from wardline.llm.packing import packed, with_digests
from wardline.llm.secrets import redacted
from wardline.llm.simhash import near_groups

_KEY = "__document"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is recognised, learned from all that are labelled."""
    return recognised(docs, fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id, null before all.

    Near copies share four fifths of their five-word shingles. The vantage-point search over five-word
    SimHashes finds candidates within its radius; fingerprints of copies with some edits are further apart
    than such a search can pay for (README), and for those compressed minima find the candidates. The sets decide.
    A document without words is a group of its own.
    """
    lowest = F.lit(-(1 << 63)).cast("long")
    key = F.struct(
        F.coalesce(F.col("doc_id"), lowest).alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash")
    )
    own = _free(_KEY, docs)
    keyed = docs.withColumn(own, key)
    named = keyed.select(F.col(own).alias("key"), "text")
    close = near_groups(named, "key", shingle=5).where("key != `group`")
    close = close.select(F.col("key").alias("one"), F.col("group").alias("two")).distinct()
    groups = similar_groups(named, "key", width=5, percent=80, also=close)
    first = groups.where(F.col("key") == F.col("group")).select(F.col("key").alias(own)).distinct()
    return keyed.join(first, own, "left_semi").dropDuplicates([own]).drop(own)


def _free(name: str, docs: DataFrame) -> str:
    """``name``, or with underscores before it if ``docs`` has such a column."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stand in benchmark windows."""
    made = ("n_words", "spans", "items")
    aside = {c: _free(f"__{c}", docs) for c in made if c in docs.columns}
    found = contaminated_spans(docs.withColumnsRenamed(aside), table(spark, sf_dir, "benchmark"))
    kept = found.where(~is_contaminated(F.col("n_words"), n_hit("spans"))).drop(*made)
    return kept.withColumnsRenamed({b: a for a, b in aside.items()}).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts, and ``n_chars``, if there is such a column, as it is then."""
    return redacted(docs, length="n_chars" if "n_chars" in docs.columns else None)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences."""
    return with_digests(packed(docs))


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("packing", packing),
]

#: No SQL can express the stages; the tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        if i:
            docs = written(docs, "stage")
        docs = stage(spark, docs, sf_dir)
    return docs
