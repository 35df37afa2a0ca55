"""Encoding of a corpus with a public byte-level BPE vocabulary.

A text is cut into pre-tokens by the vocabulary's pattern; each pre-token is merged
by a rank queue: a bucket per merge rank holds positions in a linked list of tokens,
a three-level bitmap of 64-bit words over the ranks finds the lowest rank in use by find-first-set,
and entries made stale by a neighbouring merge are skipped. A pre-token of n bytes takes
O(n log n), however long it is. Merges go by lowest rank, then leftmost.

Ranks are read on the driver and broadcast: a vocabulary file is a fixed input of about
50,000 entries. Workers keep a bounded cache of pre-tokens (a cache only: it is emptied when full).

Defined cases: null, and the empty text, have the empty list; strings of special tokens are ordinary text;
repeated rows are kept; texts of any length are encoded whole; other columns are not read.
"""

from __future__ import annotations

import base64
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The vocabulary's own pre-token pattern (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE = 300_000
#: Characters of texts whose ids go into one Arrow list, whose places are 32-bit numbers; a longer text has a list of its own.
LIST_CHARACTERS = 1 << 22


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class RankQueue:
    """Positions by merge rank; the lowest rank in use is found by find-first-set on three levels."""

    def __init__(self, ranks: int):
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket:
            heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        word, block = rank >> 6, rank >> 12
        self.low[word] |= 1 << (rank & 63)
        self.mid[block] |= 1 << (word & 63)
        self.top |= 1 << block

    def pop(self) -> tuple[int, int] | None:
        """(rank, leftmost position) of the lowest rank, or None."""
        top = self.top
        if not top:
            return None
        block = (top & -top).bit_length() - 1
        bits = self.mid[block]
        word = (block << 6) + (bits & -bits).bit_length() - 1
        bits = self.low[word]
        rank = (word << 6) + (bits & -bits).bit_length() - 1
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self.low[word] &= ~(1 << (rank & 63))
            if not self.low[word]:
                self.mid[block] &= ~(1 << (word & 63))
                if not self.mid[block]:
                    self.top &= ~(1 << block)
        return rank, position


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        import regex

        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.longest = max(map(len, ranks), default=1)
        self.cache: dict[str, list[int]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one pre-token."""
        ranks, longest, queue = self.ranks, self.longest, self.queue
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        after = list(range(1, n + 1))  # start of the next token, n at the end
        before = list(range(-1, n - 1))
        pair = [-1] * n  # rank of the merge of the token at this position with the next one; -1 where there is none or no token
        get = ranks.get
        for i in range(n - 1):
            rank = get(piece[i : i + 2], -1)
            if rank >= 0:
                pair[i] = rank
                queue.push(rank, i)
        while (item := queue.pop()) is not None:
            rank, i = item
            if pair[i] != rank:
                continue  # stale
            gone = after[i]
            end = after[gone]
            after[i] = end
            pair[gone] = -1
            if end < n:
                before[end] = i
                stop = after[end]
                rank = get(piece[i:stop], -1) if stop - i <= longest else -1
            else:
                rank = -1
            pair[i] = rank
            if rank >= 0:
                queue.push(rank, i)
            left = before[i]
            if left >= 0:
                rank = get(piece[left:end], -1) if end - left <= longest else -1
                if rank != pair[left]:
                    pair[left] = rank
                    if rank >= 0:
                        queue.push(rank, left)
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : after[i]]])
            i = after[i]
        return ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        cache, merge = self.cache, self.merge
        for piece in self.find(text):
            ids = cache.get(piece)
            if ids is None:
                ids = merge(piece.encode())
                if len(piece) <= 64:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[piece] = ids
            out += ids
        return out


def slices(texts: list[str | None], most: int = LIST_CHARACTERS) -> list[tuple[int, int]]:
    """(start, stop) of runs of texts of at most ``most`` characters in all, or of one longer text."""
    out, start, size = [], 0, 0
    for i, t in enumerate(texts):
        length = len(t or "")
        if i > start and size + length > most:
            out.append((start, i))
            start, size = i, 0
        size += length
    return [*out, (start, len(texts))] if texts else []


def encode(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text", pattern: str = PATTERN) -> DataFrame:
    """(id, ids): the token ids of every text by the vocabulary file at that path."""
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def run(batches):
        encoder = Encoder(ranks.value, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, stop in slices(texts):
                lists = [np.array(encoder.encode(t), dtype=np.int32) if t else np.zeros(0, dtype=np.int32) for t in texts[start:stop]]
                offsets = np.zeros(len(lists) + 1, dtype=np.int32)
                np.cumsum([len(x) for x in lists], out=offsets[1:])
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), ids], names=["id", "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)
