from datetime import datetime

import pytest
from pyspark.sql import functions as F

from assaymill.operators import orphans, skew
from tests.conftest import rows

REFS = "ref_table string, ref_id string, ref_at timestamp_ntz, target string"
ROWS = "target string, at timestamp_ntz, gone_at timestamp_ntz"


def day(n):
    return datetime(2025, 1 + n // 28, 1 + n % 28)


CASES = [("t", "ok", day(50), "a"), ("t", "late", day(2), "a"), ("t", "missing", day(9), "zz"), ("t", "gone", day(90), "g"), ("t", "half", day(90), "h"), ("t", "revived", day(60), "v")]
PARENTS = [("a", day(5), None), ("g", day(1), day(40)), ("g", day(30), day(41)), ("h", day(1), day(40)), ("h", day(2), None), ("v", day(1), day(20)), ("v", day(80), None)]


@pytest.mark.parametrize("cuts", [0, 2, 7])
def test_states_do_not_depend_on_the_stretches(spark, cuts):
    ledger = orphans.orphan_ledger(spark, spark.createDataFrame(CASES * 2, REFS), spark.createDataFrame(PARENTS, ROWS), cuts)
    assert rows(ledger.ledger, "ref_id", "state") == [("gone", "withdrawn"), ("half", "ok"), ("late", "late"), ("missing", "missing"), ("ok", "ok"), ("revived", "ok")]
    assert sum(r["orphans"] for r in ledger.snapshot().collect()) == 2


def test_deletions_reopen(spark):
    ledger = orphans.OrphanLedger(spark)
    parents, refs = spark.createDataFrame([("a", day(1), None)], ROWS), spark.createDataFrame([("t", "r", day(3), "a")], REFS)
    ledger.advance(refs, parents, parents.select("target").limit(0))
    assert rows(ledger.ledger, "state") == [("ok",)]
    ledger.advance(refs.limit(0), parents.limit(0), parents.select("target"))
    assert rows(ledger.ledger, "state") == [("withdrawn",)]


def test_blank_and_null_references(spark):
    df = spark.createDataFrame([("1", None, "x"), ("2", day(1), None), ("3", day(1), "x")], "id string, at timestamp_ntz, k string")
    refs = orphans.references(df, "t", "id", "at", F.lit("p"), F.col("k"))
    ledger = orphans.orphan_ledger(spark, refs, spark.createDataFrame([], ROWS))
    assert rows(ledger.ledger, "ref_id", "state") == [("1", "missing"), ("3", "missing")]


def test_empty(spark):
    assert orphans.orphan_ledger(spark, spark.createDataFrame([], REFS), spark.createDataFrame([], ROWS)).ledger.count() == 0


def test_hot_keys_join_like_others(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    monkeypatch.setattr(skew, "HOT_KEYS", 4)
    big = spark.createDataFrame([("hot", i) for i in range(60)] + [(f"k{i}", i) for i in range(20)] + [(None, 1)], "k string, i int")
    small = spark.createDataFrame([("hot", 1), ("k3", 2)], "k string, v int")
    for how, n in (("inner", 61), ("left", 81)):
        got = skew.attach(big, small, "k", how)
        assert got.count() == n and rows(got) == rows(big.join(small, "k", how))


def test_a_named_store_goes_on_and_compacts(spark, tmp_path):
    parents = spark.createDataFrame([("a", day(1), None), ("b", day(2), None)], ROWS)
    refs = spark.createDataFrame([("t", "r1", day(3), "a"), ("t", "r2", day(3), "b"), ("t", "r3", day(4), "c")], REFS)
    none = parents.limit(0)
    folder = f"file://{tmp_path}/store"
    orphans.OrphanLedger(spark, folder).advance(refs, parents, none.select("target"), "first")
    store = orphans.OrphanLedger(spark, folder)
    assert store.step == 1 and rows(store.orphans, "ref_id", "state") == [("r3", "missing")]
    store.advance(refs.limit(0), spark.createDataFrame([("c", day(9), None)], ROWS), parents.filter("target = 'a'").select("target"), "second")
    again = orphans.OrphanLedger(spark, folder)
    wanted = [("r1", "withdrawn"), ("r2", "ok"), ("r3", "late")]
    assert rows(again.ledger, "ref_id", "state") == wanted
    assert rows(again.snapshots, "as_of", "state", "n_references") == [("first", "missing", 1), ("second", "withdrawn", 1)]
    one = again.compact(f"file://{tmp_path}/one")
    assert rows(one.ledger, "ref_id", "state") == wanted and one.steps == [0] and one.snapshots.count() == 2
    one.advance(refs.limit(0), spark.createDataFrame([("a", day(10), None)], ROWS), none.select("target"))
    assert rows(one.ledger, "ref_id", "state") == [("r1", "ok"), ("r2", "ok"), ("r3", "late")]


def test_a_step_writes_what_it_changes(spark, tmp_path):
    """The second step holds one change, however many references are settled."""
    parents = spark.range(500).select(F.concat(F.lit("k"), "id").alias("target"), F.lit(day(1)).cast("timestamp_ntz").alias("at"))
    refs = parents.select(F.lit("t").alias("ref_table"), F.col("target").alias("ref_id"), F.lit(day(2)).cast("timestamp_ntz").alias("ref_at"), "target")
    store = orphans.OrphanLedger(spark, f"file://{tmp_path}/store", 64)
    store.advance(refs, parents, parents.select("target").limit(0))
    store.advance(refs.limit(0), parents.limit(0), parents.select("target").filter("target = 'k7'"))
    written = {name: spark.read.parquet(f"{tmp_path}/store/{name}/step=1").count() for name in ("index", "changes")}
    assert written == {"index": 1, "changes": 1} and rows(store.orphans, "ref_id", "state") == [("k7", "withdrawn")]
