"""Stretches whose edits stand at their ends, against brute force."""

import random

from tests.llm.test_texts import ITEM, WORDS, brute_stretch, leaks
from assaymill.llm import leakage


def test_edits_at_the_ends_of_a_stretch():
    other = ["other"] * 8
    last, first = [*other, *WORDS[5:24], "x", *other], [*other, "x", *WORDS[6:25], *other]
    both, three = [*other, *WORDS[6:24], *other], [*other, *WORDS[6:23], *other]
    outer = [*other, *WORDS[:18], *other]  # bounded by the item's first word
    assert leaks(*(" ".join(t) for t in (last, first, both, three, outer, WORDS[-19:], WORDS[-17:]))) == {0, 1, 2, 4, 5}


def test_all_edits_equal_brute_force():
    rnd, item = random.Random(11), leakage.words(ITEM)
    texts = []
    for n in range(500):
        size = rnd.choice([17, 18, 19, 20, 22, 26, 28, 30, 33])
        i = rnd.choice([0, len(item) - size, rnd.randrange(len(item) - size + 1)])
        part = item[i : i + size]
        for _ in range(rnd.randrange(5)):
            j, kind = rnd.choice([0, len(part) - 1, rnd.randrange(len(part))]), rnd.randrange(3)
            if kind == 0:
                part[j] = f"new{rnd.randrange(99)}"
            elif kind == 1:
                part.insert(j, "extra")
            else:
                del part[j]
        texts.append(" ".join([*["before"] * (8 * (n % 2)), *part, *["after"] * (8 * (n // 2 % 2))]))
    wanted = {k for k, t in enumerate(texts) if brute_stretch(item, t.split())}
    assert leaks(*texts) == wanted and 0 < len(wanted) < len(texts)
