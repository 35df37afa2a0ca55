"""Queries of the training-data operators, at production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import antibody_id, clean, residues, sequence_group_id
from ..session import table
from .bpe import encode
from .components import seed_tree_components
from .language import fit, text_segments, wrong_labels
from .leakage import leaked_items
from .overlap import CrossSplit
from .sql import SQL  # noqa: F401
from .splits import assign_splits, split_name, split_report, torn_records

#: The public vocabulary that p6_ids asks for, where this project's machines have it.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def _entities() -> dict:
    return {"antibody": antibody_id(F.col("antibody_id")), "group": sequence_group_id(F.col("sequence_group"))}


def matched_pairs(spark: SparkSession, d: str) -> DataFrame:
    queue = table(spark, d, "identity_review_queue")
    status = F.upper(clean(F.col("status")))
    live = queue.filter(F.col("withdrawn_at").isNull() & (status.isNull() | (status != "REJECTED")))
    return live.select(antibody_id(F.col("antibody_id_a")).alias("a"), antibody_id(F.col("antibody_id_b")).alias("b"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Each matched antibody with the smallest antibody of its group."""
    groups = seed_tree_components(matched_pairs(spark, d))
    return groups.select(F.col("vertex").alias("antibody_id"), F.col("component").alias("group_antibody_id"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Label rows whose related rows stand in more than one delivered split."""
    return torn_records(table(spark, d, "labels"), "label_id", _entities(), split_name(F.col("split"))).select(F.col("record").alias("label_id"))


def p2_assign(spark: SparkSession, d: str) -> DataFrame:
    """A split for every label row, whole groups in each source's proportions."""
    drawn = assign_splits(table(spark, d, "labels"), table(spark, d, "split_plan"), "label_id", "source", _entities())
    return drawn.select(F.col("record").alias("label_id"), "source", "split")


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    """Realised and wanted shares of every source and split."""
    return split_report(p2_assign(spark, d), table(spark, d, "split_plan"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return encode(table(spark, d, "documents"), VOCABULARY)


def _overlaps(spark: SparkSession, d: str) -> CrossSplit:
    return CrossSplit(
        table(spark, d, "labels"), "label_id", residues(F.col("VH")), residues(F.col("VL")), split_name(F.col("split")), ["source"]
    )


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of a held-out and a training row whose chains differ by at most five residues."""
    pairs = _overlaps(spark, d).record_pairs()
    return pairs.select(F.col("record_a").alias("label_id_a"), F.col("record_b").alias("label_id_b"))


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping pairs counted per split and source."""
    return _overlaps(spark, d).report("source")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the evaluation passages they leak."""
    return leaked_items(table(spark, d, "documents"), table(spark, d, "eval_passages"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Languages of documents whose label is missing or wrong, or that mix languages."""
    return wrong_labels(table(spark, d, "documents")).select("doc_id", "lang")


def p8_languages(spark: SparkSession, d: str) -> DataFrame:
    """Every document's stretches in one language, with their place and confidence."""
    documents = table(spark, d, "documents")
    return text_segments(documents.select("doc_id", "text"), fit(documents))


QUERIES = {"p8_found": p8_found, "p8_languages": p8_languages, "p7_found": p7_found, "p1_found": p1_found, "p2_found": p2_found, "p2_assign": p2_assign, "p2_report": p2_report, "p3_found": p3_found, "p3_report": p3_report, "p6_ids": p6_ids}
