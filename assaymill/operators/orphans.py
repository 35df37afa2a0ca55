"""References to records that do not exist: an incrementally kept store of orphans.

The store is a set of append-only tables in the shared folder, keyed by target and partitioned by step and by a bucket of the target:

* ``index``: per step what arrived and was withdrawn per target (first arrival, rows arrived, rows withdrawn; they merge by minimum and sum);
* ``settled``: references that were in order when they came;
* ``changes``: references that were not, and every later change of a state, so the latest row of a reference is its state;
* ``snapshots``: open orphans per table and month after each step. Written last: a step counts once its snapshot is there.

One step takes what happened in a stretch of time:

* arrivals and withdrawals are appended to the index;
* references new in the stretch probe the index;
* references of touched targets, waiting or settled, are judged again: arriving parents resolve waiting orphans, deletions reopen settled references.

Only the buckets of touched targets are read, and only new rows and changed states are written. A store in a named folder outlives its session: opened
again, it goes on after its last whole step. ``compact`` folds many steps into one.

States: ``missing`` (no row of that key), ``withdrawn`` (every row has a
``withdrawn_at``), ``late`` (resolved, but the first row came after the
reference) and ``ok``.

Defined cases: blank references (null, empty, white space) are not references;
a null load time of a parent counts as always there, a null load time of a
reference belongs to the first stretch and is never late; exact copies of a
reference count once; empty tables give an empty store; extra columns are
ignored, as inputs are projected to the store's own columns first.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch
from .skew import attach

REFERENCE = ["ref_table", "ref_id", "ref_at", "target"]


def references(df: DataFrame, ref_table: str, ref_id: str, at: str, target_table, target_key) -> DataFrame:
    """Reference rows of ``df``; ``target_table`` and ``target_key`` are columns already in key form."""
    return (
        df.select(
            F.lit(ref_table).alias("ref_table"), F.col(ref_id).cast("string").alias("ref_id"),
            F.col(at).alias("ref_at"), F.concat_ws("|", target_table, target_key).alias("target"),
            target_table.alias("_t"), target_key.alias("_k"),
        )
        .filter(F.col("_t").isNotNull() & F.col("_k").isNotNull())
        .select(*REFERENCE)
    )


def parents(df: DataFrame, table: str, key, at: str = "loaded_at", withdrawn: str | None = "withdrawn_at") -> DataFrame:
    """Parent rows of ``df``: target key, arrival and withdrawal time."""
    gone = F.col(withdrawn) if withdrawn else F.lit(None).cast("timestamp_ntz")
    return df.select(F.concat(F.lit(f"{table}|"), key).alias("target"), F.col(at).alias("at"), gone.alias("gone_at")).filter(
        F.col("target").isNotNull()
    )


#: States by their code in the store.
STATES = ["ok", "late", "withdrawn", "missing"]


def _code(first, arrived, gone, ref_at):
    return F.when(F.coalesce(arrived, F.lit(0)) == 0, 3).when(arrived <= gone, 2).when(first > ref_at, 1).otherwise(0)


def _mark(step, code):
    """Step and state in one number: the largest mark of a reference holds its state."""
    return (step * len(STATES) + code).cast("int")


def _code_of(mark):
    return F.pmod(mark, F.lit(len(STATES)))


def _named(code):
    return F.element_at(F.array(*map(F.lit, STATES)), code + 1)


_INDEX = "target string, first_at timestamp_ntz, arrived long, gone long, step int, bucket int"
_SETTLED = "ref_table string, ref_id string, ref_at timestamp_ntz, target string, step int, bucket int"
_CHANGES = "ref_table string, ref_id string, ref_at timestamp_ntz, target string, mark int, step int, bucket int"
_SNAPSHOTS = "as_of string, ref_table string, period string, state string, n_references long, step int"


class OrphanLedger:
    """Keyed orphan state, advanced stretch by stretch of time. ``folder`` names a store that is kept; without it the store ends with the session."""

    def __init__(self, spark: SparkSession, folder: str | None = None, buckets: int = 16):
        self.spark, self.buckets = spark, buckets
        self.scratch = Scratch(spark, "orphans")
        self.root = folder or self.scratch.path("store")
        self.steps = self._committed()
        self.step = max(self.steps, default=-1) + 1

    def _committed(self) -> list[int]:
        """Steps whose snapshot was written whole."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/snapshots")
        system = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not system.exists(folder):
            return []
        marks = system.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/snapshots/step=*/_SUCCESS"))
        return sorted(int(m.getPath().getParent().getName().split("=")[1]) for m in marks)

    def _table(self, name: str, schema: str, buckets: list[int] | None = None) -> DataFrame:
        """The rows of all whole steps, of some buckets only where they are named."""
        if not self.steps:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}")
        rows = reader.parquet(*(f"{self.root}/{name}/step={k}" for k in self.steps))
        return rows if buckets is None else rows.filter(F.col("bucket").isin(buckets))

    def _append(self, name: str, rows: DataFrame) -> None:
        rows = rows.withColumn("bucket", F.pmod(F.xxhash64("target"), F.lit(self.buckets)).cast("int"))
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/{name}/step={self.step}")

    def _latest(self, buckets: list[int] | None = None) -> DataFrame:
        """References that were ever out of order, with their state."""
        changes = self._table("changes", _CHANGES, buckets)
        return changes.groupBy(*REFERENCE).agg(F.max("mark").alias("mark")).select(*REFERENCE, _named(_code_of(F.col("mark"))).alias("state"))

    @property
    def index(self) -> DataFrame:
        return self._merged(self._table("index", _INDEX))

    @staticmethod
    def _merged(rows: DataFrame) -> DataFrame:
        return rows.groupBy("target").agg(F.min("first_at").alias("first_at"), F.sum("arrived").alias("arrived"), F.sum("gone").alias("gone"))

    @property
    def ledger(self) -> DataFrame:
        """Every reference with its state."""
        marks = self._marks(None)
        return marks.groupBy(*REFERENCE).agg(F.max("mark").alias("mark")).select(*REFERENCE, _named(_code_of(F.col("mark"))).alias("state"))

    def _marks(self, buckets: list[int] | None) -> DataFrame:
        """Every reference with the marks it ever had; a settled one has the lowest."""
        settled = self._table("settled", _SETTLED, buckets).select(*REFERENCE, _mark(F.lit(-1), F.lit(0)).alias("mark"))
        return settled.unionByName(self._table("changes", _CHANGES, buckets).select(*REFERENCE, "mark"))

    @property
    def orphans(self) -> DataFrame:
        """References that are not in order, with their state; the settled ones are not read."""
        return self._latest().filter("state <> 'ok'")

    @property
    def snapshots(self) -> DataFrame:
        """(as_of, ref_table, period, state, n_references) after every step."""
        return self._table("snapshots", _SNAPSHOTS).drop("step")

    def _buckets_of(self, rows: DataFrame) -> list[int]:
        found = rows.select(F.pmod(F.xxhash64("target"), F.lit(self.buckets)).cast("int").alias("b")).distinct().collect()  # at most ``buckets`` numbers
        return sorted(r["b"] for r in found)

    def advance(self, new_references: DataFrame, arrivals: DataFrame, withdrawals: DataFrame, as_of: str | None = None) -> None:
        """Fold one stretch in. ``arrivals`` has (target, at), ``withdrawals`` (target); ``as_of`` names the snapshot, else the step's number."""
        came = arrivals.select("target", F.col("at").alias("first_at"), F.lit(1).alias("arrived"), F.lit(0).alias("gone"))
        went = withdrawals.select("target", F.lit(None).cast("timestamp_ntz").alias("first_at"), F.lit(0).alias("arrived"), F.lit(1).alias("gone"))
        before = list(self.steps)
        self._append("index", self._merged(came.unionByName(went)))
        delta = self.spark.read.schema(_INDEX).parquet(f"{self.root}/index/step={self.step}").select("target", "first_at", "arrived", "gone")
        fresh = self.scratch.put(new_references.select(*REFERENCE), "fresh")
        now = _code(F.col("first_at"), F.col("arrived"), F.col("gone"), F.col("ref_at"))
        wanted = self._buckets_of(fresh.select("target").unionByName(delta.select("target")))

        def index(buckets: list[int]) -> DataFrame:
            of_bucket = F.pmod(F.xxhash64("target"), F.lit(self.buckets)).isin(buckets)
            return self._merged(self._table("index", _INDEX, buckets).select(*delta.columns).unionByName(delta.filter(of_bucket)))

        judged = self.scratch.put(attach(fresh, index(wanted), "target", "left").select(*REFERENCE, now.alias("code")), "judged")
        self._append("settled", judged.filter("code = 0").drop("code"))
        changed = judged.filter("code > 0")
        if before:
            touched = self._buckets_of(delta)
            # states of the touched targets: the delta's keys with everything known of them
            fresh_states = index(touched).join(delta.select("target"), "target", "left_semi")
            older = self._marks(touched).join(fresh_states, "target").groupBy(*REFERENCE, "first_at", "arrived", "gone").agg(F.max("mark").alias("mark"))
            older = older.withColumn("code", now).filter(F.col("code") != _code_of(F.col("mark"))).select(*REFERENCE, "code")
            changed = changed.unionByName(older)
        changed = changed.select(*REFERENCE, _mark(F.lit(self.step), F.col("code")).alias("mark"))
        self._append("changes", changed)
        self.steps = [*before, self.step]
        self.snapshot().select(F.lit(as_of or str(self.step)).alias("as_of"), "ref_table", "period", "state", F.col("orphans").alias("n_references")).coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{self.root}/snapshots/step={self.step}")
        for tag in ("fresh", "judged"):
            self.scratch.drop(tag)
        self.step += 1

    def snapshot(self) -> DataFrame:
        """Open orphans per table, state and month of the reference, as of the last step."""
        open_now = self._latest().filter(F.col("state").isin("missing", "withdrawn"))
        return open_now.groupBy("ref_table", F.date_format("ref_at", "yyyy-MM").alias("period"), "state").agg(F.count(F.lit(1)).alias("orphans"))

    def compact(self, folder: str) -> OrphanLedger:
        """The same state and snapshots in one step of a new store."""
        other = OrphanLedger(self.spark, folder, self.buckets)
        if other.steps:
            raise ValueError(f"there is a store already: {folder}")
        other._append("index", self.index)
        ledger = self.scratch.put(self.ledger, "compacted")
        other._append("settled", ledger.filter("state = 'ok'").drop("state"))
        code = F.array_position(F.array(*map(F.lit, STATES)), F.col("state")) - 1
        other._append("changes", ledger.filter("state <> 'ok'").select(*REFERENCE, _mark(F.lit(0), code).alias("mark")))
        self.snapshots.coalesce(1).write.mode("overwrite").parquet(f"{other.root}/snapshots/step=0")
        return OrphanLedger(self.spark, folder, self.buckets)


def _between(at, low: datetime | None, high: datetime | None, first: bool):
    inside = F.lit(True)
    if low is not None:
        inside = inside & (at >= F.lit(low).cast("timestamp_ntz"))
    if high is not None:
        inside = inside & (at < F.lit(high).cast("timestamp_ntz"))
    return (inside | at.isNull()) if first else inside


def month_cuts(low: datetime | None, high: datetime | None, cuts: int) -> list[datetime]:
    """At most ``cuts`` starts of months that part a span of time into about equal stretches."""
    if low is None or high is None:
        return []
    points = [low + (high - low) * (i + 1) / (cuts + 1) for i in range(cuts)]
    return sorted({m for p in points if low < (m := p.replace(day=1, hour=0, minute=0, second=0, microsecond=0))})


def orphan_ledger(spark: SparkSession, refs: DataFrame, rows: DataFrame, cuts: int = 2, folder: str | None = None) -> OrphanLedger:
    """Run the store over a whole history, in stretches that end at starts of months (the last one at the end of time).

    The number of stretches changes when orphans are seen to open and close, never
    the final state. Snapshots are named by the month that a stretch ends before, the last one ``end``.
    """
    scratch = Scratch(spark, "orphan-events")
    refs = scratch.put(refs.select(*REFERENCE).distinct(), "references")
    rows = scratch.put(rows.select("target", "at", "gone_at"), "parents")
    span = refs.agg(F.min("ref_at").alias("a"), F.max("ref_at").alias("b")).first()
    edges: list[datetime | None] = [None, *month_cuts(span["a"], span["b"], cuts), None]
    ledger = OrphanLedger(spark, folder)
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        ledger.advance(
            refs.filter(_between(F.col("ref_at"), low, high, i == 0)),
            rows.filter(_between(F.col("at"), low, high, i == 0)).select("target", "at"),
            rows.filter(F.col("gone_at").isNotNull() & _between(F.col("gone_at"), low, high, i == 0)).select("target"),
            high.strftime("%Y-%m") if high else "end",
        )
    for tag in ("references", "parents"):
        scratch.drop(tag)
    return ledger
