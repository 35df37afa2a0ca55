"""Transitive lineage over edge tables, its coverage and its rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch


class LineageCycle(ValueError):
    """A record refers to itself, directly or through others."""


def closure(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """(record, ancestor, depth): every ancestor at its smallest depth, by semi-naive rounds.

    Each round joins the newest pairs with the edges and keeps those not known yet, so a pair is expanded once and the rounds end at
    any depth. A cycle raises ``LineageCycle``. Null ends are no edges.
    """
    scratch = Scratch(edges.sparkSession, "lineage")
    edges = scratch.put(edges.select(F.col(child).alias("child"), F.col(parent).alias("parent")).filter("child is not null and parent is not null").distinct(), "edges")
    newest = scratch.put(edges.select(F.col("child").alias("record"), F.col("parent").alias("ancestor"), F.lit(1).alias("depth")), "depth-1")
    found, depth = [newest], 1
    while not newest.isEmpty():
        if not newest.filter("record = ancestor").isEmpty():
            raise LineageCycle("lineage contains a cycle")
        depth += 1
        step = newest.join(edges, F.col("ancestor") == F.col("child")).select("record", F.col("parent").alias("ancestor")).distinct()
        step = step.join(reduce(DataFrame.unionByName, found), ["record", "ancestor"], "left_anti").withColumn("depth", F.lit(depth))
        newest = scratch.put(step, f"depth-{depth}")
        found.append(newest)
    return reduce(DataFrame.unionByName, found)


def coverage(records: DataFrame, covered: DataFrame, by: str) -> DataFrame:
    """Per value of ``by``: records, records with lineage, and their share (1 for none)."""
    joined = records.select(by, "record").distinct().join(covered.select("record").distinct().withColumn("hit", F.lit(1)), "record", "left")
    return joined.groupBy(by).agg(F.count(F.lit(1)).alias("n_records"), F.count("hit").alias("n_covered")).withColumn(
        "share", F.when(F.col("n_records") == 0, 1.0).otherwise(F.col("n_covered") / F.col("n_records"))
    )


def edge_rules(lineage: DataFrame, required: list[str], hash_column: str, commit_column: str, row_column: str, id_column: str) -> DataFrame:
    """(rule, violations) of lineage edges, in one pass for the row rules."""
    checks = {f"blank_{c}": (F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")) for c in required}
    checks["bad_hash"] = F.col(hash_column).isNotNull() & ~F.col(hash_column).rlike("^[0-9a-f]{64}$")
    checks["bad_commit"] = F.col(commit_column).isNotNull() & ~F.col(commit_column).rlike("^[0-9a-f]{40}$")
    checks["bad_row"] = F.col(row_column).isNotNull() & (F.col(row_column) < 1)
    row_rules = lineage.agg(*(F.count(F.when(c, 1)).alias(n) for n, c in checks.items()))
    long = row_rules.select(F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in checks))).alias("r")).select("r.*")
    repeated = lineage.groupBy(id_column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").agg(F.lit("repeated_id").alias("rule"), F.count(F.lit(1)).alias("violations"))
    return long.unionByName(repeated)


def leaf_references(records: DataFrame, record: str, embedded: str, references: str, own: str, dictionary: str) -> DataFrame:
    """(record, kind, source): what each record derives from, by the first of four columns that is filled.

    Embedded sources (a JSON list of texts) come before references to other records (joined by ``|``), those before the
    record's own source column, and that before its dictionary column. A record without any raises.
    """
    def filled(c: str):
        return F.col(c).isNotNull() & (F.trim(F.col(c)) != "") & (F.trim(F.col(c)) != "[]")

    pipes = lambda c: F.filter(F.transform(F.split(c, r"\|"), lambda x: F.trim(x)), lambda x: x != "")
    kind = F.when(filled(embedded), "embedded").when(filled(references), "reference").when(filled(own), "own").when(filled(dictionary), "dictionary")
    sources = (
        F.when(F.col("kind") == "embedded", F.from_json(embedded, "array<string>")).when(F.col("kind") == "reference", pipes(references))
        .when(F.col("kind") == "own", F.array(own)).otherwise(F.array(dictionary))
    )
    rows = records.withColumn("kind", kind)
    bare = rows.filter("kind is null").select(F.col(record).cast("string")).limit(1).collect()
    if bare:
        raise ValueError(f"record without lineage: {bare[0][0]}")
    return rows.select(F.col(record).alias("record"), "kind", F.explode(sources).alias("source")).distinct()


def edge_rows(references: DataFrame, rules: DataFrame, prefix: str = "LINEAGE") -> DataFrame:
    """Reference rows with the rule and script of their kind and a content id over record, kind and source."""
    joined = references.join(F.broadcast(rules), "kind", "left")  # one rule per kind of reference
    content = F.sha2(F.concat_ws("\x1f", "record", "kind", "source"), 256)
    return joined.withColumn("lineage_id", F.concat(F.lit(f"{prefix}:"), F.substring(content, 1, 24)))


def unknown_rules(edges: DataFrame, rule: str, known: list[str]) -> DataFrame:
    """(rule, n_edges): rules that edges name and that no rule table holds; a missing rule counts as one."""
    return edges.groupBy(F.col(rule).alias("rule")).agg(F.count(F.lit(1)).alias("n_edges")).filter(F.col("rule").isNull() | ~F.col("rule").isin(known))
