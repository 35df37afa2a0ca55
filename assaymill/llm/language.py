"""Language of texts and of the passages inside them.

A multinomial naive Bayes over hashed character n-grams is fitted on a bounded sample of
labelled texts (``SAMPLE`` per language, those with the smallest hash of their id), then fitted
again on the sample's sentences that the first fit finds in their label's language, which sheds
wrong labels and mixed texts. Its log-probability matrix (languages x ``BUCKETS``, a fixed size) is broadcast;
texts are scored in Arrow batches as sparse sums in numpy. The likelihoods are tempered, so that confidences are shares of right answers:
each half of the sample's sentences is told by a model of the other half, and the temperature with the least log loss is taken.

A text is cut into sentences; each gets the posterior of every language. Sentences not told clearly from the text's main language
count as that; sentences too short to stand by themselves join the sentence beside them if they are clearly in its language. A passage is two
or more sentences of one language, which a passage of another language may interrupt. A text is in every language of its passages, or,
without a passage, in the language of its sentences together. Segments are the stretches of a text in one of its languages.

Defined cases: null, empty and blank texts and texts without prose (sequences, numbers, codes) have no language; a label
that is null, blank, a placeholder or no language name is no label; names, codes and regions of a language are the same label;
foreign terms and phrases inside a sentence, and single foreign sentences, make no passage; quoted lines are prose, header lines of sequences (one
word after ``>``) and markup tags of any length are not; very long texts are read whole; without any labelled text no language is told; ties go to
the alphabetically first language; other columns are not read.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import clean
from ..session import Scratch

#: The languages with the codes and names that mean them (primary part, lower case).
LANGUAGES = {
    "de": ["de", "deu", "ger", "german", "deutsch", "allemand", "alemán"],
    "en": ["en", "eng", "english", "englisch", "anglais", "inglés"],
    "es": ["es", "spa", "spanish", "español", "espanol", "castellano", "spanisch"],
    "fr": ["fr", "fra", "fre", "french", "français", "francais", "französisch"],
    "it": ["it", "ita", "italian", "italiano", "italienisch"],
    "pt": ["pt", "por", "portuguese", "português", "portugues", "portugiesisch"],
    "ru": ["ru", "rus", "russian", "русский", "russisch"],
    "zh": ["zh", "zho", "chi", "cmn", "chinese", "中文", "汉语", "chinesisch", "mandarin"],
}
CODES = list(LANGUAGES)
#: Labelled texts per language that the model is fitted on.
SAMPLE = 300
BUCKETS = 1 << 15
ORDERS = (1, 2, 3, 4)
#: Log probability of everything in a language without labelled texts.
UNSEEN = -60.0
#: Letters (ideographs count three) and words (or ideographs) a sentence needs to be told by itself.
LEAST, LEAST_WORDS = 18, 4
#: Log likelihood by which a sentence must favour another language than the text's main one.
MARGIN = 12.0
#: Log likelihood by which a short sentence must be in a language to join a sentence of it, and the letters it needs.
JOINS, JOINS_LETTERS = 6.0, 8
#: Temperatures tried.
TEMPERATURES = [2.0 ** (k / 2) for k in range(0, 21)]
_TAG = re.compile(r"</?[A-Za-z!?][^<>]*>")
_REFERENCE = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")
_LINK = re.compile(r"https?://\S+")
_QUOTE = re.compile(r"^>(?:[^\s>]*[^\S\n]*$|)", re.M)
_CODE = re.compile(r"[A-Z](?<!\w[A-Z])(?:[A-Z]{0,5}-?[0-9]+|[A-Z*\-]{14,})(?!\w)")
#: A sentence ends after the first character of a match.
_END = re.compile(r"[.!?…;．。！？；\n](?:(?<=[.!?…;．])[\"”“»«’')\]]*\s+|(?<=[。！？；])|(?<=\n)\s*\n)")
_LETTERS = re.compile(r"[^\W\d_]+")
_IDEOGRAPH = re.compile(r"[㐀-鿿豈-﫿]")


def label_code(c: Column) -> Column:
    """One of ``CODES`` for a label that means it; ``other`` for another text; null for none."""
    low = F.regexp_replace(F.lower(clean(c)), r"[-_ ].*$", "")
    out = F.when(c.isNull() | (low == ""), F.lit(None).cast("string"))
    for code, names in LANGUAGES.items():
        out = out.when(low.isin(names), code)
    return out.otherwise("other")


def _blank(match: re.Match) -> str:
    return " " * len(match[0])


def _resolved(match: re.Match) -> str:
    said = html.unescape(match[0])
    return (said if len(said) == 1 and said not in "<>" else " ").ljust(len(match[0]), "\u200b")


def spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, sentence): sentences as lower-case letters between single blanks, and where they stand; those without letters are dropped."""
    if not text:
        return []
    plain = text  # every step keeps positions
    if "<" in plain:
        plain = _TAG.sub(_blank, plain)
    if "&" in plain:
        plain = _REFERENCE.sub(_resolved, plain)
    if "http" in plain:
        plain = _LINK.sub(_blank, plain)
    if ">" in plain:
        plain = _QUOTE.sub(_blank, plain)
    stable = unicodedata.is_normalized("NFKC", plain)
    plain = _CODE.sub(_blank, plain)
    out, start = [], 0
    for end, after in [*((m.start() + 1, m.end()) for m in _END.finditer(plain)), (len(plain), len(plain))]:
        part = plain[start:end]
        if "\u200b" in part:
            part = part.replace("\u200b", "")
        if not stable:
            part = _CODE.sub(_blank, unicodedata.normalize("NFKC", part))
        letters = " ".join(_LETTERS.findall(part)).lower()
        if letters:
            out.append((start, end, letters))
        start = after
    return out


def sentences(text: str | None) -> list[str]:
    """The sentences of ``spans``."""
    return [s for _, _, s in spans(text)]


def ideographs(sentence: str) -> int:
    return 0 if sentence.isascii() else len(_IDEOGRAPH.findall(sentence))


def weight_of(sentence: str) -> int:
    """Letters, an ideograph counting three."""
    return len(sentence) - sentence.count(" ") + 2 * ideographs(sentence)


def is_prose(sentence: str) -> bool:
    words = sentence.count(" ") + 1
    if words >= LEAST_WORDS and len(sentence) - words + 1 >= LEAST:
        return True
    signs = ideographs(sentence)
    return len(sentence) - words + 1 + 2 * signs >= LEAST and (words >= LEAST_WORDS or signs >= LEAST_WORDS)


def ngram_orders(parts: list[str]) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of each order, by the place they start at; ``BUCKETS`` where one would cross a sentence's end."""
    text = "".join([f" {p} " for p in parts])
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    ends = np.cumsum([len(p) + 2 for p in parts])
    rolled = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, max(ORDERS) + 1):
        if len(codes) < n:
            break
        rolled = rolled[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :]
        if n in ORDERS:
            buckets = (((rolled + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int64)
            for k in range(1, n):
                crossing = ends - k
                buckets[crossing[crossing < len(buckets)]] = BUCKETS
            yield buckets


def ngrams(parts: list[str]) -> np.ndarray:
    """Buckets of all n-grams of some sentences."""
    found = np.concatenate([np.zeros(0, dtype=np.int64), *ngram_orders(parts)]) if parts else np.zeros(0, dtype=np.int64)
    return found[found < BUCKETS]


def scores(parts: list[str], log_probability: np.ndarray) -> np.ndarray:
    """Log likelihood of every sentence in every language."""
    table = np.concatenate([log_probability, np.zeros((1, log_probability.shape[1]), dtype=log_probability.dtype)])
    out = np.zeros((len(parts), table.shape[1]))
    start = 0
    while start < len(parts):
        stop, size = start, 0
        while stop < len(parts) and (stop == start or size + len(parts[stop]) < 32_000):
            size += len(parts[stop]) + 2
            stop += 1
        total, taken = np.zeros((size, table.shape[1]), dtype=np.float32), np.empty((size, table.shape[1]), dtype=np.float32)
        for buckets in ngram_orders(parts[start:stop]):
            np.take(table, buckets, axis=0, out=taken[: len(buckets)], mode="clip")
            total[: len(buckets)] += taken[: len(buckets)]
        sizes = np.array([len(p) + 2 for p in parts[start:stop]])
        out[start:stop] = np.add.reduceat(total, np.cumsum(sizes) - sizes, axis=0)
        start = stop
    return out


def posterior(likelihood: np.ndarray, temperature: float = 1.0) -> np.ndarray:
    if not len(likelihood):
        return likelihood
    p = np.exp((likelihood - likelihood.max(axis=-1, keepdims=True)) / temperature)
    return p / p.sum(axis=-1, keepdims=True)


def told(parts: list[str], likelihood: np.ndarray) -> dict[int, int]:
    """Language number of each sentence that has one: those that stand by themselves, and short ones that join one beside them."""
    prose = [i for i, p in enumerate(parts) if is_prose(p)]
    if not prose:
        return {}
    main = int(likelihood[prose].sum(axis=0).argmax())
    best = likelihood.argmax(axis=1)
    lead = likelihood.max(axis=1) - likelihood[:, main]
    language = np.where(lead >= MARGIN, best, main).tolist()
    out = {i: language[i] for i in prose}
    if len(out) < len(parts):
        second = np.sort(likelihood, axis=1)[:, -2] if likelihood.shape[1] > 1 else np.full(len(parts), -np.inf)
        for beside in (-1, 1):
            for i in range(len(parts))[::-beside]:
                if i not in out and out.get(i + beside) == best[i] and likelihood[i].max() - second[i] >= JOINS and weight_of(parts[i]) >= JOINS_LETTERS:
                    out[i] = int(best[i])
    return out


def languages_of(parts: list[str], likelihood: np.ndarray) -> dict[int, list[int]]:
    """Language numbers of a text, each with its sentences; empty for a text without prose."""
    by: dict[int, list[int]] = {}
    for i, k in sorted(told(parts, likelihood).items()):
        by.setdefault(k, []).append(i)
    long = {k: run for k, run in by.items() if len(run) >= 2}
    if long or not by:
        return long
    k = max(sorted(by), key=lambda k: sum(weight_of(parts[i]) for i in by[k]))
    return {k: by[k]}


def segments_of(parts: list[str], likelihood: np.ndarray) -> list[tuple[int, list[int]]]:
    """(language number, sentences) of each stretch of a text in one of its languages; single foreign sentences belong to the stretch around."""
    found = languages_of(parts, likelihood)
    language = {i: k for k, run in found.items() for i in run}
    out: list[tuple[int, list[int]]] = []
    for i in sorted(language):
        if out and out[-1][0] == language[i]:
            out[-1][1].append(i)
        else:
            out.append((language[i], [i]))
    return out


class Model(NamedTuple):
    """Log probabilities (buckets x languages) and the temperature of confidences."""

    matrix: np.ndarray
    temperature: float


def _counts(log_probability: np.ndarray | None):
    """n-gram counts per half of the sample and language of labelled texts; with a model, only of sentences it finds in the label's language."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, len(CODES), BUCKETS), dtype=np.int64)
        for batch in batches:
            for text, label, half in zip(batch["t"], batch["label"], batch["half"]):
                parts = [p for p in sentences(text) if is_prose(p)]
                k = CODES.index(label)
                if log_probability is not None and parts:
                    best = scores(parts, log_probability).argmax(axis=1)
                    parts = [p for p, b in zip(parts, best) if b == k]
                if parts:
                    total[half, k] += np.bincount(ngrams(parts), minlength=BUCKETS)
        half, k, bucket = np.nonzero(total)
        yield pd.DataFrame({"half": half.astype(np.int32), "k": k.astype(np.int32), "bucket": bucket.astype(np.int32), "n": total[half, k, bucket]})

    return run


def _losses(halves: list[np.ndarray]):
    """Log loss of sentences by temperature, each told by the model of the other half, in texts that it finds in their label's language."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loss = np.zeros(len(TEMPERATURES))
        for batch in batches:
            for text, label, half in zip(batch["t"], batch["label"], batch["half"]):
                parts = [p for p in sentences(text) if is_prose(p)]
                if not parts:
                    continue
                likelihood = scores(parts, halves[1 - half])
                k = CODES.index(label)
                if int(likelihood.sum(axis=0).argmax()) == k and set(languages_of(parts, likelihood)) == {k}:
                    loss += [-np.log(np.maximum(posterior(likelihood, t)[:, k], 1e-300)).sum() for t in TEMPERATURES]
        yield pd.DataFrame({"i": np.arange(len(loss), dtype=np.int32), "loss": loss})

    return run


def _log_share(table: np.ndarray) -> np.ndarray:
    share = (table + 0.5) / (table.sum(axis=0) + 0.5 * BUCKETS)
    return np.where(table.sum(axis=0) > 0, np.log(share), UNSEEN).astype(np.float32)


def fit(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang", sample: int = SAMPLE) -> Model:
    """The model of a bounded sample of labelled texts; the corpus is read once for the ids and labels and once for the sample's texts."""
    labelled = documents.select(F.col(doc_id).alias("d"), label_code(F.col(label)).alias("label"), (F.length(text) > 0).alias("full"))
    labelled = labelled.filter(F.col("label").isin(CODES) & F.col("full")).select("d", "label")
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("d"), "d"))
    chosen = labelled.withColumn("rank", rank).filter(F.col("rank") <= sample)
    half = F.pmod("rank", F.lit(2)).cast("int").alias("half")
    # at most sample x languages rows
    rows = documents.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).join(F.broadcast(chosen), "d").select("t", "label", half)
    scratch = Scratch(documents.sparkSession, "language")
    rows = scratch.put(rows, "sample").repartition(documents.sparkSession.sparkContext.defaultParallelism)
    log_probability, table = None, np.zeros((2, BUCKETS, len(CODES)))
    for _ in range(2):
        counted = rows.mapInPandas(_counts(log_probability), "half int, k int, bucket int, n long").groupBy("half", "k", "bucket").agg(F.sum("n").alias("n"))
        found = counted.toPandas()  # at most 2 x languages x BUCKETS rows
        table = np.zeros((2, BUCKETS, len(CODES)))
        table[found["half"].to_numpy(), found["bucket"].to_numpy(), found["k"].to_numpy()] = found["n"].to_numpy()
        log_probability = _log_share(table.sum(axis=0))
    losses = rows.mapInPandas(_losses([_log_share(t) for t in table]), "i int, loss double").groupBy("i").agg(F.sum("loss").alias("loss")).collect()
    scratch.drop("sample")
    best = min(((r["loss"], r["i"]) for r in losses), default=(0.0, 0))[1]
    return Model(log_probability, TEMPERATURES[best])


def _scored(documents: DataFrame, model: Model, doc_id: str, text: str, keep: list[str], columns: str, describe) -> DataFrame:
    """One row per (row, values) that ``describe(index, spans, likelihood, temperature)`` yields for the texts."""
    sent = documents.sparkSession.sparkContext.broadcast(tuple(model))
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches):
        matrix, temperature = sent.value
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                cut = [spans(t) for t in part.column(0).to_pylist()]
                flat = [s for one in cut for *_, s in one]
                likelihood = scores(flat, matrix)
                at, row, values = 0, [], []
                for i, one in enumerate(cut):
                    for value in describe(one, likelihood[at : at + len(one)], temperature):
                        row.append(i)
                        values.append(value)
                    at += len(one)
                kept = part.take(pa.array(row, type=pa.int64()))
                found = pd.DataFrame(values, columns=names)
                arrays = [pa.array(found[n], type=kind) for n, kind in zip(names, kinds)]
                yield pa.RecordBatch.from_arrays([*(kept.column(i) for i in range(1, kept.num_columns)), *arrays], names=[*kept.schema.names[1:], *names])

    kinds = [{"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64()}[c.split()[1]] for c in columns.split(", ")]
    rows = documents.select(F.col(text).alias("_text"), doc_id, *keep)
    if not (model.matrix > UNSEEN).any():  # without labelled texts no language can be told
        rows = rows.limit(0)
    carried = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(run, f"{carried}, {columns}")


def text_languages(documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", keep: list[str] = ()) -> DataFrame:
    """(id, kept columns, lang_found, letters, confidence, n_langs): one row per language of each text with prose."""

    def describe(one, likelihood, temperature):
        parts = [s for *_, s in one]
        found = languages_of(parts, likelihood)
        for k in sorted(found):
            sure = float(posterior(likelihood[found[k]].sum(axis=0), temperature)[k])
            yield CODES[k], sum(weight_of(parts[i]) for i in found[k]), sure, len(found)

    return _scored(documents, model, doc_id, text, list(keep), "lang_found string, letters long, confidence double, n_langs int", describe)


def text_segments(documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", keep: list[str] = ()) -> DataFrame:
    """(id, kept columns, segment, start, end, lang, letters, confidence): one row per stretch of one language, by characters of the text."""

    def describe(one, likelihood, temperature):
        parts = [s for *_, s in one]
        for number, (k, run) in enumerate(segments_of(parts, likelihood)):
            sure = float(posterior(likelihood[run].sum(axis=0), temperature)[k])
            yield number, one[run[0]][0], one[run[-1]][1], CODES[k], sum(weight_of(parts[i]) for i in run), sure

    return _scored(documents, model, doc_id, text, list(keep), "segment int, start long, end long, lang string, letters long, confidence double", describe)


def wrong_labels(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """(id, lang, confidence) of texts whose label is missing, names no or another language, or that mix languages."""
    model = fit(documents, doc_id, text, label)
    rows = documents.select(doc_id, text, label_code(F.col(label)).alias("_label"))
    found = text_languages(rows, model, doc_id, text, ["_label"])
    wrong = (F.col("n_langs") > 1) | F.col("_label").isNull() | (F.col("_label") != F.col("lang_found"))
    return found.filter(wrong).select(doc_id, F.col("lang_found").alias("lang"), "confidence").dropDuplicates([doc_id, "lang"])
