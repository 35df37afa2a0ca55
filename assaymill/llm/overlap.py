"""Same or near-same records across splits.

Records are pairs of chains. Equal pairs collapse to one sequence first. Each
sequence gets minwise hashes of its residue 3-mers (of both chains, told apart), grouped
into bands; two sequences meet where a band agrees, one of them held out and the
other in training. ``SKETCH`` one-bit minwise hashes travel along, so that members of one family, which
share frameworks and hence some bands, part inside the join and are never emitted. A band that very many sequences
share is split into parts of at most ``PART`` met pairs. Candidates are verified by the exact Jaccard similarity of their 3-mer sets; only
those at the bound that the allowed edits imply have their edits counted.

With at most ``edits`` edits a pair of n 3-mers keeps a similarity of at least
(n - 3 * edits) / (n + 3 * edits): 0.87 for chains of 230 residues in all. 40 bands of 8 rows then miss
one such pair in ten million, and its sketches differ in 17 bits (standard deviation 4); more than ``SKETCH_BITS`` come
as rarely. Sequences shorter than ``SHORT`` residues in all or, as repetitive ones, with fewer than ``DISTINCT``
distinct 3-mers (n counts those), where that bound gives out, take an exact way besides, whose candidates are verified alike: cut
into edits + 1 pieces, one of which a partner holds unchanged at a place shifted by at most ``edits``.

Defined cases: a record without one of its chains (null, blank or only gap marks), without an id, or without a
split is not compared; case, width, white space, gap marks and a closing ``*`` are no difference; records
of other splits than train, valid and test are not compared; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import attach
from ..session import Scratch

BANDS, ROWS = 40, 8
#: One-bit minwise hashes of a sketch, and how many of them may differ.
SKETCH, SKETCH_BITS = 256, 40
#: Residues in all (both chains) under which the exact way joins in.
SHORT = 200
#: Distinct 3-mers under which it joins in, whatever the length.
DISTINCT = 190
#: Pairs of a held-out and a training sequence that one part of a band may hold.
PART = 4_000_000
_SEED = 20240607


def shingle_codes(heavy: str, light: str) -> np.ndarray:
    """Distinct 3-mers of both chains as ascending small integers."""
    letters = np.frombuffer(f"{heavy}@@{light}".encode("ascii", "replace"), dtype=np.uint8).astype(np.uint32) & 31
    codes = (letters[:-2] << 10) + (letters[1:-1] << 5) + letters[2:]
    codes = np.concatenate([codes[: max(len(heavy) - 2, 0)], codes[len(heavy) + 2 :] + 32768])
    codes.sort()
    return codes[np.flatnonzero(np.diff(codes, prepend=np.uint32(1 << 20)))]


def with_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to rows with heavy and light: ``codes``, their distinct 3-mers; ``keys``, one 64-bit key per band; s0 to s3, the sketch."""
    random = np.random.default_rng(_SEED)
    mix = random.permutation(1 << 16).astype(np.uint32) * np.uint32(65521) ^ random.integers(0, 1 << 32, 1 << 16, dtype=np.uint32)
    factor = random.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
    shift = random.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
    weight = random.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
    offset = random.integers(1, 1 << 63, BANDS, dtype=np.uint64)
    for batch in batches:
        codes = [shingle_codes(h, l) for h, l in zip(batch.column("heavy").to_pylist(), batch.column("light").to_pylist())]
        least = np.zeros((len(codes), BANDS * ROWS), dtype=np.uint32)
        for row, of_row in zip(least, codes):
            if len(of_row):
                hashed = mix[of_row][:, None] * factor
                hashed += shift
                hashed.min(axis=0, out=row)
        sketch = np.packbits(((least ^ (least >> np.uint32(7)) ^ (least >> np.uint32(13)))[:, :SKETCH] & np.uint32(1)).astype(np.uint8), axis=1).view(np.int64)
        key = (least.astype(np.uint64).reshape(-1, BANDS, ROWS) * weight).sum(axis=2, dtype=np.uint64) ^ offset
        key = ((key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)
        filled = np.array([len(c) > 0 for c in codes], dtype=bool)

        def lists(flat: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat, kind))

        yield pa.RecordBatch.from_arrays(
            [*batch.columns, lists((np.concatenate([np.zeros(0, dtype=np.int64), *codes]) - 32768).astype(np.int16), np.array([len(c) for c in codes], dtype=np.int64), pa.int16()),
             lists(key[filled].ravel(), filled * BANDS, pa.int64()), *(pa.array(sketch[:, i]) for i in range(4))],
            names=[*batch.schema.names, "codes", "keys", "s0", "s1", "s2", "s3"],
        )


def piece_keys(edits: int):
    """Keys of short sequences: of their own pieces (``side`` 0) and of what may match pieces of a partner (``side`` 1)."""

    def pieces(n: int) -> list[tuple[int, int]]:
        cuts = [n * i // (edits + 1) for i in range(edits + 2)]
        return list(zip(cuts, cuts[1:]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for seq, held, train, size, heavy, light in zip(*(batch[c] for c in ("seq", "held", "train", "size", "heavy", "light"))):
                text = heavy + "|" + light
                n = len(text)
                if train:
                    rows += [(seq, 0, size, f"{n} {i} {text[a:b]}") for i, (a, b) in enumerate(pieces(n))]
                if held:
                    probes = set()
                    for m in range(max(1, n - edits), n + edits + 1):
                        for i, (a, b) in enumerate(pieces(m)):
                            for at in range(max(0, a - edits), min(n - (b - a), a + edits) + 1):
                                probes.add(f"{m} {i} {text[at : at + b - a]}")
                    rows += [(seq, 1, size, p) for p in sorted(probes)]
            yield pd.DataFrame(rows, columns=["seq", "side", "size", "key"])

    return run


def least_similarity(size_a: Column, size_b: Column, edits: int) -> Column:
    """Jaccard similarity that ``edits`` edits leave two sets of distinct 3-mers: each takes three away and brings three at most."""
    return (F.greatest(size_a, size_b) - 3 * edits) / (F.least(size_a, size_b) + 3 * edits) - F.lit(1e-9)


class CrossSplit:
    """Cross-split overlaps of a table of paired chains."""

    def __init__(self, records: DataFrame, record: str, heavy: Column, light: Column, split: Column, keep: list[str] = (), edits: int = 5, part: int = PART):
        self.edits, self.part = edits, part
        spark = records.sparkSession
        self.scratch = Scratch(spark, "overlap")
        rows = records.select(
            F.col(record).alias("record"), heavy.alias("heavy"), light.alias("light"), split.alias("split"), *keep, F.monotonically_increasing_id().alias("row")
        ).withColumn("digest", F.unhex(F.sha2(F.concat_ws("|", "heavy", "light"), 256)))
        # filtered after it is written: a filter would be pushed below and clean every chain twice
        rows = self.scratch.put(rows, "rows").filter(
            F.col("record").isNotNull() & F.col("heavy").isNotNull() & F.col("light").isNotNull() & F.col("split").isin("train", "valid", "test")
        )
        # one sequence per distinct pair of chains, named by its smallest record; its chains come from one of its rows
        held = F.col("split") != "train"
        classes = rows.groupBy("digest").agg(F.min("record").alias("seq"), F.min("row").alias("first"), F.max(held).alias("held"), F.max(~held).alias("train"))
        self.members = self.scratch.put(attach(rows, self.scratch.put(classes, "classes"), "digest").drop("digest"), "members")
        for tag in ("rows", "classes"):
            self.scratch.drop(tag)
        sequences = self.members.filter("row = first").select("seq", "heavy", "light", "held", "train", (F.length("heavy") + F.length("light")).alias("size"))
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sequences.schema.fields)
        sequences = sequences.mapInArrow(with_bands, f"{kinds}, codes array<smallint>, keys array<long>, s0 long, s1 long, s2 long, s3 long")
        self.sequences = self.scratch.put(sequences, "sequences")

    def _parts(self) -> DataFrame | None:
        """(key, parts) of the bands that more than ``part`` pairs share; None where there are none."""
        keyed = self.sequences.select(F.explode("keys").alias("key"), F.col("held").cast("long").alias("h"), F.col("train").cast("long").alias("t"))
        # a bucket of keys cannot hold such a band unless it has as many pairs itself, so the buckets, few and combined before they are exchanged, are counted first
        pairs = F.sum("h").cast("double") * F.sum("t")
        full = self.scratch.put(keyed.groupBy(F.pmod("key", F.lit(1 << 16)).alias("bucket")).agg(pairs.alias("pairs")).filter(F.col("pairs") > self.part).select("bucket"), "buckets")
        if full.isEmpty():
            return None
        counted = keyed.withColumn("bucket", F.pmod("key", F.lit(1 << 16))).join(F.broadcast(full), "bucket")  # at most 65,536 rows
        counted = counted.groupBy("key").agg(pairs.alias("pairs")).filter(F.col("pairs") > self.part)
        hot = self.scratch.put(counted.select("key", F.ceil(F.col("pairs") / self.part).alias("parts")), "hot-bands")
        return None if hot.isEmpty() else hot

    def candidates(self) -> DataFrame:
        """(a, b): held-out sequence and training sequence that share a band or a piece; each pair once."""
        sketch = [f"s{i}" for i in range(4)]
        keyed = self.sequences.select("seq", "held", "train", "size", *sketch, F.explode("keys").alias("key"))
        held = keyed.filter("held").select(F.col("seq").alias("a"), F.col("size").alias("size_a"), "key", *(F.col(c).alias(f"{c}_a") for c in sketch))
        train = keyed.filter("train").select(F.col("seq").alias("b"), F.col("size").alias("size_b"), "key", *(F.col(c).alias(f"{c}_b") for c in sketch))
        near = (F.col("a") != F.col("b")) & (F.abs(F.col("size_a") - F.col("size_b")) <= self.edits)
        differing = F.expr(" + ".join(f"bit_count({c}_a ^ {c}_b)" for c in sketch))
        on, hot = ["key"], self._parts()
        if hot is not None:  # each part of a hot band has a share of its training sequences and all held-out ones
            on = ["key", "part"]
            parts = F.coalesce("parts", F.lit(1))
            held = held.join(hot, "key", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("parts")
            train = train.join(hot, "key", "left").withColumn("part", F.pmod(F.xxhash64("b"), parts)).drop("parts")
        found = held.join(train, on).filter(near & (differing <= SKETCH_BITS)).select("a", "b")
        # an edit changes the residues by one and the distinct 3-mers by three at most, so both ends of a pair are taken
        bare = (F.col("size") < SHORT + self.edits) | (F.size("codes") < DISTINCT + 3 * self.edits)
        short = self.sequences.filter(bare).select("seq", "held", "train", "size", "heavy", "light")
        pieces = short.mapInPandas(piece_keys(self.edits), "seq long, side int, size int, key string")
        own = pieces.filter("side = 0").select(F.col("seq").alias("b"), F.col("size").alias("size_b"), "key")
        probe = pieces.filter("side = 1").select(F.col("seq").alias("a"), F.col("size").alias("size_a"), "key")
        return found.unionByName(probe.join(own, "key").filter(near).select("a", "b")).distinct()

    def sequence_pairs(self) -> DataFrame:
        """(a, b, edits, jaccard): verified pairs of a held-out and a training sequence, equal ones included."""
        limit = self.edits

        def side(x: str) -> DataFrame:
            return self.sequences.select(F.col("seq").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("heavy", "light", "codes")))

        pairs = self.candidates().join(side("a"), "a").join(side("b"), "b")
        size_a, size_b, both = F.size("codes_a"), F.size("codes_b"), F.size(F.array_intersect("codes_a", "codes_b"))
        pairs = pairs.withColumn("jaccard", F.coalesce(F.try_divide(both, size_a + size_b - both), F.lit(0.0)))
        similar = F.col("jaccard") >= least_similarity(size_a, size_b, limit)
        # both distances in one number, so that each is computed once; -1 stands for more than the limit
        base = limit + 2
        edits = F.when(similar, F.levenshtein("heavy_a", "heavy_b", limit) * base + F.levenshtein("light_a", "light_b", limit))
        allowed = [h * base + l for h in range(limit + 1) for l in range(limit + 1 - h)]
        pairs = pairs.withColumn("edits", edits).filter(F.col("edits").isin(allowed))
        total = (F.floor(F.col("edits") / base) + F.col("edits") % base).cast("int").alias("edits")
        equal = self.sequences.filter("held and train").select(F.col("seq").alias("a"), F.col("seq").alias("b"), F.lit(0).alias("edits"), F.lit(1.0).alias("jaccard"))
        return pairs.select("a", "b", total, "jaccard").unionByName(equal)

    def record_pairs(self) -> DataFrame:
        """(record_a, record_b), smaller first: every overlapping pair of records."""
        pairs = self.scratch.put(self.sequence_pairs().select("a", "b"), "pairs")
        held = self.members.filter("split <> 'train'").select(F.col("seq").alias("a"), F.col("record").alias("x"))
        train = self.members.filter("split = 'train'").select(F.col("seq").alias("b"), F.col("record").alias("y"))
        both = pairs.join(held, "a").join(train, "b")
        return both.select(F.least("x", "y").alias("record_a"), F.greatest("x", "y").alias("record_b"))

    def report(self, source: str) -> DataFrame:
        """Overlapping pairs of records per split and source of both ends, counted from classes without spelling pairs out."""
        pairs = self.scratch.put(self.sequence_pairs().select("a", "b", "edits"), "report-pairs")
        counted = self.members.groupBy("seq", "split", source).agg(F.count(F.lit(1)).alias("n"))
        held = counted.filter("split <> 'train'").select(F.col("seq").alias("a"), F.col("split"), F.col(source).alias("held_source"), F.col("n").alias("n_a"))
        train = counted.filter("split = 'train'").select(F.col("seq").alias("b"), F.col(source).alias("train_source"), F.col("n").alias("n_b"))
        joined = pairs.join(held, "a").join(train, "b")
        return joined.groupBy("split", "held_source", "train_source", (F.col("edits") == 0).alias("equal")).agg(
            F.sum(F.col("n_a") * F.col("n_b")).alias("n_pairs")
        )
