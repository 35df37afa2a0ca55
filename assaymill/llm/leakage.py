"""Evaluation passages that stand in corpus texts, whole or in part, literally or nearly.

A text leaks an item when it holds a stretch of at least ``STRETCH`` consecutive words
of the item in which at most one word in ten is replaced, dropped or added, wherever the edits stand. Such a
stretch holds a run of ``WINDOW`` unchanged words (20 words with two edits have a run of six, 30 with
three a run of seven), so the item is cut into windows of that size. Each window has a SimHash
of its words; 16-bit blocks index the fingerprints, which finds every item window within
a Hamming radius of three of a text's window. A met window makes a candidate of the text around it, whether its
words are equal or not. Candidates are verified exactly: first by the share of the
item's word pairs, weighted by how often they stand there, that the text around holds in the best window of
``STRETCH`` words, which must reach what the allowed edits leave; then by the edit distance between every window of
20 (with two edits) or 30 words (with three) of the item and that part of the text. A longer stretch within the bound can be cut into
two of which one is within the bound, so these two sizes suffice.

Items are a query set. Up to ``ITEM_BYTES`` of them (measured) they are indexed once and broadcast; beyond that both
sides' distinct fingerprints meet in a shuffle join.

Defined cases: null, empty and short texts leak nothing; items under ``STRETCH`` words have no such stretch and are never leaked; words are
split at white space and long dashes, without markup tags of any length, punctuation, case, width, ligatures and composition, and with
character references resolved; repeated rows are reported once per id;
items that share wording are each reported; very long texts are read whole, in chunks; other columns are not read.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import defaultdict
from hashlib import blake2b
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch

STRETCH, WINDOW, RADIUS = 20, 6, 3
#: Allowed edits, by size of a stretch.
BOUNDS = ((STRETCH, 2), (STRETCH + STRETCH // 2, 3))
#: Words around a met window that a stretch may reach.
REACH = 34
#: Characters of items that are indexed in one broadcast; it takes some 300 bytes a word.
ITEM_BYTES = 32 * 1024 * 1024
#: Words whose windows are hashed at once, and words of a text compared with an item at once.
CHUNK, REGION = 60_000, 2_000
#: Words of texts whose hashes a worker keeps.
KEPT_WORDS = 400_000

_TAG = re.compile(r"</?[A-Za-z!?][^<>]*>")
_REFERENCE = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")
_SPLIT = re.compile(r"[\s—―–]+")
_DROP = re.compile(r"[\W_]+")


def _character(reference: re.Match) -> str:
    said = html.unescape(reference[0])
    return " " if said in "<>" else said


def words(text: str | None) -> list[str]:
    """Words of a text in comparable form."""
    if not text:
        return []
    plain = _TAG.sub(" ", text) if "<" in text else text
    if "&" in plain:
        plain = _REFERENCE.sub(_character, plain)
    if plain.isascii():
        plain = plain.lower()
    else:
        plain = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", plain).casefold())
    return [w for w in (_DROP.sub("", t) for t in _SPLIT.split(plain)) if w]


class Lexicon:
    """Numbers words and keeps the sign bits of their 64-bit hashes; ``known`` words keep their numbers for good."""

    def __init__(self, known: list[str] = ()):
        self.known = list(known)
        self.bits = np.zeros((0, 64), dtype=np.int8)
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.hashed = 0
        self.numbers(self.known)

    def numbers(self, tokens: list[str]) -> np.ndarray:
        number = self.number
        fresh = [w for w in dict.fromkeys(tokens) if w not in number]
        if fresh:
            number.update(zip(fresh, range(len(number), len(number) + len(fresh))))
            if len(number) > len(self.bits):
                self.bits = np.concatenate([self.bits, np.zeros((max(1024, len(self.bits), len(number)), 64), dtype=np.int8)])
            digests = np.frombuffer(b"".join(blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest() for w in fresh), dtype=np.uint8)
            self.bits[self.hashed : len(number)] = np.unpackbits(digests).reshape(-1, 64).astype(np.int8) * 2 - 1
            self.hashed = len(number)
        return np.fromiter(map(number.__getitem__, tokens), dtype=np.int64, count=len(tokens))

    def simhash(self, numbers: np.ndarray, window: int = WINDOW) -> np.ndarray:
        """SimHash of every window of the word numbers."""
        if len(numbers) < window:
            return np.zeros(0, dtype=np.uint64)
        signs = self.bits[numbers]
        total = signs[: len(numbers) - window + 1].copy()
        for k in range(1, window):
            total += signs[k : len(numbers) - window + 1 + k]
        return np.packbits(total >= 0, axis=1).view(np.uint64).ravel()


class ItemIndex:
    """Fingerprints of all windows of some items, by four 16-bit blocks."""

    def __init__(self, items: list[tuple[int, str]]):
        lexicon = Lexicon()
        self.ids = [i for i, _ in items]
        self.numbers = [lexicon.numbers(words(text)) for _, text in items]
        found = [lexicon.simhash(numbers) for numbers in self.numbers]
        prints = np.concatenate([np.zeros(0, dtype=np.uint64), *found])
        self.owner = np.repeat(np.arange(len(found)), [len(x) for x in found])
        self.place = np.concatenate([np.zeros(0, dtype=np.int64), *(np.arange(len(x)) for x in found)])
        self.distinct, back = np.unique(prints, return_inverse=True)
        self.of_print = np.argsort(back, kind="stable")
        self.start = np.searchsorted(back[self.of_print], np.arange(len(self.distinct) + 1))
        self.blocks = []
        for b in range(4):
            part = ((self.distinct >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
            by = np.argsort(part, kind="stable")
            self.blocks.append((by, np.searchsorted(part[by], np.arange(65537))))
        self.lexicon = Lexicon(list(lexicon.number))

    def parts(self) -> dict:
        """What a worker needs, in plain arrays."""
        return {k: v for k, v in vars(self).items() if k != "lexicon"} | {"known": self.lexicon.known}

    @classmethod
    def of(cls, parts: dict) -> ItemIndex:
        index = cls.__new__(cls)
        vars(index).update({k: v for k, v in parts.items() if k != "known"}, lexicon=Lexicon(parts["known"]))
        return index

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text window, distinct item fingerprint) pairs within the radius."""
        lefts, rights = [], []
        for b, (by, start) in enumerate(self.blocks):
            part = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
            first, count = start[part], start[part + 1] - start[part]
            left = np.repeat(np.arange(len(prints)), count)
            if not len(left):
                continue
            step = np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
            right = by[np.repeat(first, count) + step]
            close = np.bitwise_count(prints[left] ^ self.distinct[right]) <= RADIUS
            lefts.append(left[close])
            rights.append(right[close])
        if not lefts:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        pair = np.unique(np.concatenate(lefts) * max(len(self.distinct), 1) + np.concatenate(rights))
        return pair // max(len(self.distinct), 1), pair % max(len(self.distinct), 1)


def nearest(windows: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Fewest edits (words replaced, dropped or added) from each row of ``windows`` to any part of the text."""
    step = np.arange(len(text) + 1, dtype=np.int16)
    last = np.zeros((len(windows), len(text) + 1), dtype=np.int16)
    for a in range(windows.shape[1]):
        now = np.full_like(last, a + 1)
        now[:, 1:] = np.minimum(last[:, 1:] + 1, last[:, :-1] + (windows[:, a, None] != text[None, :]))
        last = np.minimum.accumulate(now - step, axis=1) + step
    return last.min(axis=1)


def stands_straight(item: np.ndarray, text: np.ndarray, shift: int) -> bool:
    """Is there a stretch with replaced words only, item word ``i`` against text word ``i + shift``?"""
    low, high = max(0, -shift), min(len(item), len(text) - shift)
    other = np.cumsum(np.concatenate([[0], item[low:high] != text[low + shift : high + shift]])) if high > low else np.zeros(1)
    return any(len(other) > size and (other[size:] - other[:-size]).min() <= most for size, most in BOUNDS)


def holds_stretch(item: np.ndarray, text: np.ndarray) -> bool:
    """Does the text hold a stretch of the item with at most one edit in ten words?"""
    for size, most in BOUNDS:
        if len(item) < size:
            continue
        windows = np.lib.stride_tricks.sliding_window_view(item, size)
        for start in range(0, max(len(text) - 2 * REACH, 1), REGION):
            part = text[start : start + REGION + 2 * REACH]
            if any(nearest(windows[k : k + 128], part).min() <= most for k in range(0, len(windows), 128)):
                return True
    return False


def shingle_share(item: np.ndarray, text: np.ndarray, stretch: int = STRETCH) -> float:
    """Largest share of the word pairs of a ``stretch``-word window of the item that the text holds, each weighted by its count."""
    if len(item) < 2 or len(text) < 2:
        return 0.0
    base = int(max(item.max(), text.max())) + 1
    ours, theirs = item[:-1] * base + item[1:], np.unique(text[:-1] * base + text[1:])
    held = np.isin(ours, theirs).astype(np.int64)
    size = min(stretch - 1, len(held))
    run = np.concatenate([[0], np.cumsum(held)])
    return float((run[size:] - run[:-size]).max()) / (stretch - 1)


#: Share of the weighted word pairs of a window that the allowed edits leave.
LEAST_SHARE = 1 - 2 * BOUNDS[-1][1] / (STRETCH - 1) - 1e-9


def verified(item: np.ndarray, text: np.ndarray, seeds: list[tuple[int, int]]) -> bool:
    """Does the text hold a stretch of the item around one of the met windows (item place, text place)?"""
    seeds = sorted(seeds, key=lambda seed: seed[1])
    first = 0
    for k in range(1, len(seeds) + 1):
        if k < len(seeds) and seeds[k][1] - seeds[k - 1][1] <= 2 * REACH:
            continue
        group, first = seeds[first:k], k
        low, high = max(0, group[0][1] - REACH), group[-1][1] + WINDOW + REACH
        near = text[low:high]
        places = [i for i, _ in group]
        begin = max(0, min(places) - REACH)
        part = item[begin : max(places) + WINDOW + REACH]
        if shingle_share(part, near) < LEAST_SHARE:
            continue
        if any(stands_straight(part, near, shift) for shift in {j - low - (i - begin) for i, j in group}) or holds_stretch(part, near):
            return True
    return False


def leaks_of(index: ItemIndex, ids: list, texts: list[str | None]) -> list[tuple]:
    """(id, item) pairs of a few texts, whose windows are hashed and looked up together."""
    lexicon = index.lexicon
    listed = [words(t) for t in texts]
    sizes = np.array([len(x) for x in listed], dtype=np.int64)
    numbers = lexicon.numbers([w for x in listed for w in x])
    begin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)
    met: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
    for start in range(0, max(len(numbers) - WINDOW + 1, 0), CHUNK):
        part = numbers[start : start + CHUNK + WINDOW - 1]
        first = owner[start : start + len(part) - WINDOW + 1]
        inside = np.flatnonzero(first == owner[start + WINDOW - 1 : start + len(part)])  # windows within one text
        left, right = index.near(lexicon.simhash(part)[inside])
        for j, p in zip((inside[left] + start).tolist(), right.tolist()):
            doc = int(owner[j])
            for w in index.of_print[index.start[p] : index.start[p + 1]]:
                met[doc, int(index.owner[w])].append((int(index.place[w]), j - int(begin[doc])))
    out = [
        (ids[doc], index.ids[k]) for (doc, k), seeds in met.items()
        if len(index.numbers[k]) >= STRETCH and verified(index.numbers[k], numbers[begin[doc] : begin[doc] + sizes[doc]], seeds)
    ]
    if len(lexicon.number) > KEPT_WORDS:
        lexicon.clear()
    return out


def window_prints(batches):
    """(k, print) of the windows of texts (k, t); each fingerprint once a text."""
    lexicon = Lexicon()
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            rows = batch.slice(start, 256)
            found = [np.unique(lexicon.simhash(lexicon.numbers(words(t)))).view(np.int64) for t in rows.column(1).to_pylist()]
            keys = np.repeat(np.array(rows.column(0).to_pylist(), dtype=np.int64), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *found]))], names=["k", "print"])
            if len(lexicon.number) > KEPT_WORDS:
                lexicon.clear()


def block_keys(fingerprint: Column) -> Column:
    """Keys of which fingerprints within the radius share one: any three of six blocks, some 32 bits each."""
    edges = [0, 11, 22, 33, 44, 54, 64]
    blocks = [F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:])]
    chosen = list(combinations(range(6), 6 - RADIUS))
    return F.array(*(F.xxhash64(F.lit(n), *(blocks[i] for i in c)) for n, c in enumerate(chosen)))


def candidate_pairs(texts: DataFrame, items: DataFrame) -> DataFrame:
    """(d, i): texts and items (k, t each) that have windows within the radius; distinct fingerprints meet, so a phrase in many rows is one."""
    scratch = Scratch(texts.sparkSession, "leakage")
    sides = []
    for df, name in ((texts, "d"), (items, "i")):
        prints = scratch.put(df.mapInArrow(window_prints, "k long, print long"), f"prints-{name}")
        keyed = prints.select("print").distinct().select(F.col("print").alias(f"print_{name}"), F.explode(block_keys(F.col("print"))).alias("key"))
        sides.append((prints.select(F.col("k").alias(name), F.col("print").alias(f"print_{name}")), keyed))
    (of_text, text_keys), (of_item, item_keys) = sides
    near = text_keys.join(item_keys, "key").filter(F.bit_count(F.col("print_d").bitwiseXOR(F.col("print_i"))) <= RADIUS).select("print_d", "print_i").distinct()
    return near.join(of_item, "print_i").select("print_d", "i").distinct().join(of_text, "print_d").select("d", "i").distinct()


def leaked_items(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(doc_id, item_id): every text with the items it leaks."""
    spark = documents.sparkSession
    known = items.select(F.col(item_id).cast("long").alias("k"), F.col(text).alias("t")).filter("k is not null and t is not null").distinct()
    rows = documents.select(F.col(doc_id).cast("long").alias("k"), F.col(text).alias("t")).filter("k is not null and t is not null")

    def found(pairs: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pandas(pd.DataFrame(pairs, columns=["d", "i"]).astype("int64"), preserve_index=False)

    if (known.agg(F.sum(F.octet_length("t"))).first()[0] or 0) <= item_bytes:
        sent = spark.sparkContext.broadcast(ItemIndex([(r["k"], r["t"]) for r in known.collect()]).parts())  # at most item_bytes of text

        def look_up(batches):
            index = ItemIndex.of(sent.value)
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    yield found(leaks_of(index, part.column(0).to_pylist(), part.column(1).to_pylist()))

        result = rows.mapInArrow(look_up, "d long, i long")
    else:

        def verify(batches):
            for batch in batches:
                yield found([p for d, t, i, u in zip(*(c.to_pylist() for c in batch.columns)) for p in leaks_of(ItemIndex([(i, u)]), [d], [t])])

        pairs = candidate_pairs(rows, known).join(known.select(F.col("k").alias("i"), F.col("t").alias("u")), "i")
        result = pairs.join(rows.select(F.col("k").alias("d"), "t"), "d").select("d", "t", "i", "u").mapInArrow(verify, "d long, i long")
    return result.distinct().select(F.col("d").alias(doc_id), F.col("i").alias(item_id))
