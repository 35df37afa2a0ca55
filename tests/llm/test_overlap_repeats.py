"""Near-equal pairs of repetitive chains, which have few distinct 3-mers for their length."""

import random

from tests.conftest import rows
from tests.llm.test_overlap import LETTERS, found


def test_repetitive_chains_are_all_found(spark):
    rnd, data, wanted = random.Random(3), [], set()
    for k in range(0, 40, 2):
        heavy = [rnd.choice(LETTERS) for _ in range(56)]
        other = list(heavy)
        for i in (5, 16, 27, 38, 49):
            other[i] = "A" if heavy[i] != "A" else "C"
        data += [(k, "".join(heavy) + "G" * 64, "S" * 110, "train"), (k + 1, "".join(other) + "G" * 64, "S" * 110, "test")]
        wanted.add((k, k + 1))
    assert set(rows(found(spark, data).record_pairs())) == wanted
