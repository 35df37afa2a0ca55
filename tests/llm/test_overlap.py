import random

import pyarrow as pa

from pyspark.sql import functions as F

from assaymill.functions.text import residues
from assaymill.llm import overlap
from assaymill.llm.overlap import CrossSplit
from tests.conftest import rows

LETTERS = "ACDEFGHIKLMNPQRSTVWY"
SCHEMA = "id long, VH string, VL string, split string, source string, seq string, key string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def mutate(rnd, text, edits):
    text = list(text)
    for _ in range(edits):
        i, kind = rnd.randrange(len(text)), rnd.randrange(3)
        if kind == 0:
            text[i] = rnd.choice(LETTERS)
        elif kind == 1:
            text.insert(i, rnd.choice(LETTERS))
        elif len(text) > 1:
            del text[i]
    return "".join(text)


def records():
    rnd = random.Random(11)
    chain = lambda n: "".join(rnd.choice(LETTERS) for _ in range(n))
    out, number = [], 0
    for size in (120, 110, 80, 79, 40, 12, 4, 2):
        for _ in range(4):
            heavy, light = chain(size), chain(max(2, size - 8))
            for split in ("train", "valid", "test", "train"):
                for edits in (0, 2, 3):
                    out.append((number, mutate(rnd, heavy, edits), mutate(rnd, light, rnd.randrange(edits + 1)), split))
                    number += 1
    return out


def found(spark, data):
    df = spark.createDataFrame([(*r, "s", "x", "y") for r in data], SCHEMA)
    return CrossSplit(df, "id", residues(F.col("VH")), residues(F.col("VL")), F.col("split"), ["source"])


def test_against_brute_force(spark):
    data = records()
    wanted = set()
    for i, (a, ha, la, sa) in enumerate(data):
        for b, hb, lb, sb in data[i + 1 :]:
            if (sa == "train") != (sb == "train") and abs(len(ha) - len(hb)) <= 5 and abs(len(la) - len(lb)) <= 5:
                h = distance(ha, hb)
                if h <= 5 and h + distance(la, lb) <= 5:
                    wanted.add((a, b))
    overlaps = found(spark, data)
    got = rows(overlaps.record_pairs())
    assert len(got) == len(set(got)) and set(got) == wanted
    assert sum(r["n_pairs"] for r in overlaps.report("source").collect()) == len(wanted)


def test_written_forms_and_missing_values(spark):
    heavy, light = "ACDEFGHIKLMNPQRSTVWY" * 5, "YWVTSRQPNMLKIHGFEDCA" * 5
    data = [
        (1, heavy, light, "train"), (2, f" {heavy[:9].lower()}--{heavy[9:]}*\n", light, "test"), (3, None, light, "test"), (4, heavy, " ", "valid"), (5, heavy, light, None),
        (6, heavy, light, "holdout"), (7, heavy, light, "train"),
    ]
    assert rows(found(spark, data).record_pairs()) == [(1, 2), (2, 7)]
    assert found(spark, data[2:3]).record_pairs().count() == 0
    assert found(spark, []).record_pairs().count() == 0


def test_split_bands_lose_nothing(spark):
    data = records()
    df = spark.createDataFrame([(*r, "s", "x", "y") for r in data], SCHEMA)
    whole = found(spark, data)
    parts = CrossSplit(df, "id", residues(F.col("VH")), residues(F.col("VL")), F.col("split"), ["source"], part=4)
    assert whole._parts() is None and parts._parts().count() > 0
    assert rows(parts.candidates()) == rows(whole.candidates()) and rows(parts.record_pairs()) == rows(whole.record_pairs())


def test_every_pair_of_five_edits_meets_in_a_band():
    """Recall of bands and sketches by length, pairs of exactly five edits far apart, which change most 3-mers."""
    rnd = random.Random(5)
    for size in (100, 108, 115, 130, 200):
        pairs = []
        for _ in range(300):
            chains = ["".join(rnd.choice(LETTERS) for _ in range(size)) for _ in range(2)]
            other = [list(c) for c in chains]
            for n in range(5):
                chain = other[n % 2]
                at = (n // 2 + 1) * size // 4
                chain[at] = rnd.choice([x for x in LETTERS if x != chain[at]])
            pairs += [chains, ["".join(c) for c in other]]
        batch = pa.RecordBatch.from_pydict({"heavy": [p[0] for p in pairs], "light": [p[1] for p in pairs]})
        out = next(overlap.with_bands([batch])).to_pylist()
        for a, b in zip(out[::2], out[1::2]):
            both = len(set(a["codes"]) & set(b["codes"]))
            assert both / (len(a["codes"]) + len(b["codes"]) - both) >= (len(a["codes"]) - 15) / (len(a["codes"]) + 15) - 1e-9
            assert any(x == y for x, y in zip(a["keys"], b["keys"]))
            assert sum(((a[f"s{i}"] ^ b[f"s{i}"]) & (1 << 64) - 1).bit_count() for i in range(4)) <= overlap.SKETCH_BITS


def test_verified_pairs_keep_the_similarity(spark):
    for r in found(spark, records()).sequence_pairs().filter("a <> b").collect():
        assert 0 <= r["edits"] <= 5 and 0 <= r["jaccard"] <= 1


def test_similarity_decides_before_edits(spark, monkeypatch):
    """Without the similarity no pair comes out, however few its edits."""
    monkeypatch.setattr(overlap, "least_similarity", lambda a, b, edits: F.lit(2.0))
    assert found(spark, records()).sequence_pairs().filter("a <> b").count() == 0
