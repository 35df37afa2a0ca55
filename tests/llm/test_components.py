import random

import pytest
from pyspark.sql import functions as F

from assaymill.llm import components, splits
from assaymill.operators import skew
from tests.conftest import rows

METHODS = [components.seed_tree_components, components.star_components]


def brute(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return sorted((v, find(v)) for v in list(parent))


def shapes():
    rnd = random.Random(4)
    chain = [(f"c{i:03}", f"c{i + 1:03}") for i in range(40)]
    rnd.shuffle(chain)
    star = [("zz", f"s{i:03}") for i in range(60)]
    low_star = [("aa", f"t{i:03}") for i in range(30)]
    mixed = [(f"r{rnd.randrange(60):02}", f"r{rnd.randrange(60):02}") for _ in range(45)]
    tree = [(f"n{i:03}", f"n{(i - 1) // 2:03}") for i in range(1, 63)]
    return chain + star + low_star + mixed + tree + [("x", "x"), (None, "y"), ("z", None)] + mixed[::-1] + [(b, a) for a, b in star]


@pytest.mark.parametrize("method", METHODS)
def test_against_union_find(spark, method, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 8)
    pairs = shapes()
    assert rows(method(spark.createDataFrame(pairs, "a string, b string"))) == brute(pairs)


@pytest.mark.parametrize("method", METHODS)
def test_numbers_empty_and_clashing_columns(spark, method):
    df = spark.createDataFrame([(3, 1, "m", 0), (3, 2, "m", 0), (9, 8, None, 1)], "a long, b long, u string, v int")
    assert rows(method(df)) == [(1, 1), (2, 1), (3, 1), (8, 8), (9, 8)]
    assert method(df.limit(0)).count() == 0
    assert method(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")).count() == 0


LABELS = "label_id long, antibody string, grp string, split string, source string, record string, component string"
def entities():
    return {"antibody": F.col("antibody"), "group": F.col("grp")}


def labels(spark):
    data = [
        (1, "A", "G1", "train"), (2, "A", "G2", "test"), (3, "B", "G2", None), (4, "C", "G3", "train"), (5, "C", None, "training "), (6, None, None, "dev"), (7, None, None, None),
        (8, None, "G4", "val"), (9, "D", "G4", "Validation"),
    ]
    return spark.createDataFrame([(*r, "s", "x", "y") for r in data], LABELS)


def test_torn_records(spark):
    got = splits.torn_records(labels(spark), "label_id", entities(), splits.split_name(F.col("split")))
    assert rows(got) == [(1,), (2,), (3,)]
    assert splits.torn_records(labels(spark).limit(0), "label_id", entities(), splits.split_name(F.col("split"))).count() == 0


def test_split_names(spark):
    df = spark.createDataFrame([(v,) for v in ("Training", " test", "Test\t", "dev", "val", "", "n/a", None, "holdout")], "v string")
    assert [r[0] for r in df.select(splits.split_name(F.col("v"))).collect()] == ["train", "test", "test", "valid", "valid", None, None, None, "holdout"]


def test_assigned_splits_keep_components_and_proportions(spark):
    data = [(i, f"A{i // 3}", f"G{i // 6}", None, "s1" if i % 2 else "s2", "x", "y") for i in range(6000)]
    plan = spark.createDataFrame([(s, k, f) for s, fs in (("s1", (0.8, 0.1, 0.1)), ("s2", (0.6, 0.2, 0.2))) for k, f in zip(splits.SPLITS, fs)], "source string, split string, fraction double")
    got = splits.assign_splits(spark.createDataFrame(data, LABELS), plan, "label_id", "source", entities())
    found = got.collect()
    assert len(found) == 6000 and len({(r["component"], r["split"]) for r in found}) == len({r["component"] for r in found}) == 1000
    share = sum(r["split"] == "train" for r in found) / 6000
    assert abs(share - 0.7) < 0.05
    for r in splits.split_report(got, plan).collect():
        assert abs(r["share"] - r["wanted"]) < 0.15 and r["n_rows"] > 0
    unknown = spark.createDataFrame([(1, "A", None, None, "elsewhere", "x", "y")], LABELS)
    assert splits.assign_splits(unknown, plan, "label_id", "source", entities()).first()["split"] in splits.SPLITS
