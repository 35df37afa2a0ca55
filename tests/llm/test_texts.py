import os
import random

import numpy as np
import pytest

from assaymill.llm import bpe, language, leakage
from assaymill.llm.queries import VOCABULARY
from tests.conftest import rows

D = "/root/testdata/sf0.001"
has_vocabulary = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary")


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(VOCABULARY))


def reference_encoding(text):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.read_ranks(VOCABULARY), special_tokens={}).encode_ordinary(text)


@has_vocabulary
def test_encoding_equals_a_public_implementation(encoder):
    rnd = random.Random(7)
    texts = ["a", "don't stop", "  \n\t x", "<|endoftext|> ordinary", "naïve 漢字 🙂‍🙂", " 　", "1234567 3.14", "ab" * 4000, "A" * 5001, "ACDEFGHIKLMNPQRSTVWY" * 300]
    texts += ["".join(rnd.choice("abcdething ") for _ in range(400)) for _ in range(50)]
    texts += ["".join(chr(rnd.randrange(32, 1500)) for _ in range(80)) for _ in range(50)]
    for text in texts:
        assert encoder.encode(text) == reference_encoding(text)


@has_vocabulary
def test_round_trip_and_long_pretokens(encoder):
    tokens = {i: t for t, i in encoder.ranks.items()}
    text = "".join(random.Random(1).choice("acgt") for _ in range(60000))
    assert b"".join(tokens[i] for i in encoder.encode(text)).decode() == text


def test_merges_go_by_rank_then_from_the_left():
    ranks = {bytes([c]): i for i, c in enumerate(b"abc")} | {b"aa": 3, b"ab": 4, b"aab": 5}
    encoder = bpe.Encoder(ranks, r"\S+")
    assert encoder.encode("aaa") == [3, 0] and encoder.encode("aaab") == [3, 4] and encoder.encode("aab") == [5]


def test_rank_queue_pops_in_order():
    rnd, queue, items = random.Random(2), bpe.RankQueue(60000), []
    for _ in range(3000):
        items.append((rnd.randrange(60000), rnd.randrange(100)))
        queue.push(*items[-1])
    assert [queue.pop() for _ in items] == sorted(items) and queue.pop() is None and not any(queue.low) and not any(queue.mid)


@has_vocabulary
def test_encoding_table(spark, encoder):
    df = spark.createDataFrame([(1, "hello world", "x"), (2, None, "x"), (3, "", "x"), (1, "hello world", "x"), (None, " ", "x")], "doc_id long, text string, ids string")
    got = rows(bpe.encode(df, VOCABULARY), "doc_id", "ids")
    assert got == [(1, encoder.encode("hello world"))] * 2 + [(2, []), (3, []), (None, encoder.encode(" "))]
    assert bpe.encode(df.limit(0), VOCABULARY).count() == 0


def test_lists_are_cut_by_characters():
    assert bpe.slices(["ab", None, "c", "defgh", "", "i"], 3) == [(0, 3), (3, 4), (4, 6)] and bpe.slices([]) == [] and bpe.slices(["long text"], 3) == [(0, 1)]


ITEM = (
    "Neither shear nor lyophilisation altered the framework map of FEX-4511, but 39 vials became hazy. Whenever pumping precedes dialysis, the light contact oscillated unless "
    "sucrose exceeds 12 parts in 480. Rank GIL-3442, GIL-2368 and GIL-9927 by tolerance of oxidation, assuming sorbitol at 54 millimolar."
)
WORDS = ITEM.split()


def leaks(*texts):
    return {d for d, _ in leakage.leaks_of(leakage.ItemIndex([(7, ITEM), (8, "too short an item"), (9, "")]), list(range(len(texts))), list(texts))}


def test_stretches_and_their_bounds():
    filler = "the assay team compared two panels and found the ranking of many candidates borderline "
    replaced = WORDS[5:25]
    replaced[6], replaced[13] = "garden", "window"
    dropped = WORDS[5:12] + WORDS[13:19] + WORDS[20:26]
    three = WORDS[5:25]
    three[4], three[9], three[14] = "a1", "a2", "a3"
    marked = "<b>" + "</b> <br/>".join(WORDS[3:25]).upper() + "</b>"
    quoted = "> " + "\n> ".join(" ".join(WORDS[i : i + 5]) for i in range(0, 30, 5))
    wide = "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in " ".join(WORDS[:22]))
    assert leaks(
        filler + " ".join(WORDS[2:22]), filler * 20 + " ".join(replaced) + " " + filler, " ".join(dropped), " ".join(WORDS[2:20]), " ".join(three), marked, quoted, wide, None, "",
        filler * 3, " ".join(WORDS[::-1]),
    ) == {0, 1, 2, 3, 5, 6, 7}  # fmt: skip (18 words in a row are 20 whose first and last are dropped)
    long = WORDS[:36]
    long[11], long[14], long[17] = "b1", "b2", "b3"
    assert leaks(" ".join(long)) == {0}


def brute_stretch(item, text):
    """Does some 20-word window of the item lie within two edits of the text, or a 30-word window within three, with matched ends?"""
    for size, most in ((20, 2), (30, 3)):
        for i in range(len(item) - size + 1):
            window = item[i : i + size]
            last = [0] * (len(text) + 1)
            for a, word in enumerate(window, 1):
                now = [a]
                for j, other in enumerate(text, 1):
                    now.append(min(last[j] + 1, now[j - 1] + 1, last[j - 1] + (word != other)))
                last = now
            if min(last) <= most:
                return True
    return False


def test_random_edits_against_brute_force():
    rnd, item = random.Random(5), leakage.words(ITEM)
    texts = []
    for _ in range(150):
        size = rnd.choice([14, 17, 24, 28, 33, 38])
        i = rnd.randrange(len(item) - size + 1)
        part = item[i : i + size]
        for _ in range(rnd.randrange(6)):
            j, kind = rnd.randrange(2, len(part) - 2), rnd.randrange(3)
            if kind == 0:
                part[j] = f"new{rnd.randrange(99)}"
            elif kind == 1:
                part.insert(j, "extra")
            else:
                del part[j]
        texts.append(" ".join(["before"] * 8 + part + ["after"] * 8))
    wanted = {k for k, t in enumerate(texts) if brute_stretch(item, t.split())}
    assert leaks(*texts) == wanted and 0 < len(wanted) < len(texts)


def test_markup_of_any_length_and_character_references():
    link = "<a href='" + "x/" * 300 + "'>"
    inside = " ".join([*WORDS[2:9], link, *WORDS[9:16], "</a><!-- " + "c" * 400 + " -->", *WORDS[16:22]])
    item = "D'après le cahier de laboratoire, l'échantillon a été étudié par l'électrophorèse capillaire à 30 °C, parce que le tampon & la colonne avaient changé."
    written = item.replace("'", "&#x27;", 1).replace("'", "&#39;", 1).replace("'", "&rsquo;").replace("°", "&deg;").replace("&", "&amp;", 0).upper().replace("&#X", "&#x").replace("&RSQUO;", "&rsquo;").replace("&DEG;", "&deg;")
    index = leakage.ItemIndex([(1, ITEM), (2, item)])
    assert leakage.words(written) == leakage.words(item)
    assert sorted(leakage.leaks_of(index, [10, 20, 30], [inside, written, "a < b and c > d"])) == [(10, 1), (20, 2)]


def test_recall_on_planted_stretches():
    rnd, item = random.Random(23), leakage.words(ITEM)
    texts = []
    for _ in range(1000):
        size = rnd.choice([20, 21, 25, 29, 30, 34])
        i = rnd.randrange(len(item) - size + 1)
        part = item[i : i + size]
        for _ in range(size // 10):
            j, kind = rnd.randrange(len(part)), rnd.randrange(3)
            part[j : j + (kind != 1)] = [] if kind == 2 else [f"new{rnd.randrange(999)}"]
        texts.append(" ".join([*(f"w{rnd.randrange(99)}" for _ in range(30)), *part, *(f"w{rnd.randrange(99)}" for _ in range(30))]))
    assert len(leaks(*texts)) == 1000


def test_met_windows_need_not_be_equal(monkeypatch):
    """Windows of another text within the radius are verified as such: rows do not rest on equal words."""
    index = leakage.ItemIndex([(7, ITEM)])
    near = index.near
    monkeypatch.setattr(index, "near", lambda prints: tuple(x[:1] for x in near(prints)))  # one met window only
    text = " ".join([*WORDS[:12], "other", *WORDS[13:30]])
    assert leakage.leaks_of(index, [1], [text]) == [(1, 7)]
    item, found = index.numbers[0], index.lexicon.numbers(leakage.words(text))
    assert leakage.verified(item, found, [(8, 8)])  # this window holds the replaced word


def test_many_items_meet_by_shuffle(spark):
    rnd = random.Random(3)
    items = [(k, " ".join(f"{rnd.choice('abcdefgh')}{rnd.randrange(400)}" for _ in range(40))) for k in range(30)]
    texts = []
    for n in range(60):
        words = items[n % 30][1].split()[5 : 5 + rnd.choice([16, 20, 26])]
        words[3] = "changed"
        texts.append((n, " ".join([*["pre"] * 9, *words, *["post"] * 9])))
    documents, passages = spark.createDataFrame([*texts, (99, None), (100, "")], "doc_id long, text string"), spark.createDataFrame([*items, (77, None)], "item_id long, text string")
    wanted = rows(leakage.leaked_items(documents, passages))
    assert wanted == rows(leakage.leaked_items(documents, passages, item_bytes=0)) and 20 < len(wanted) < 60


def test_every_window_within_the_radius_is_found():
    index = leakage.ItemIndex([(7, ITEM)])
    rnd = np.random.default_rng(3)
    picked = rnd.integers(0, len(index.distinct), 400)
    flipped = index.distinct[picked].copy()
    for k in range(len(flipped)):
        for bit in rnd.choice(64, leakage.RADIUS, replace=False):
            flipped[k] ^= np.uint64(1) << np.uint64(bit)
    left, right = index.near(flipped)
    assert set(zip(range(400), picked)) <= set(zip(left.tolist(), right.tolist()))


def test_leaked_items_table(spark):
    documents = spark.createDataFrame([(1, ITEM, "x"), (1, ITEM, "x"), (2, None, "x"), (None, ITEM, "x"), (3, ITEM * 200, "x")], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(7, ITEM, 1), (8, ITEM + " And more.", 1), (9, None, 1)], "item_id long, text string, doc_id int")
    assert rows(leakage.leaked_items(documents, items)) == [(1, 7), (1, 8), (3, 7), (3, 8)]
    assert leakage.leaked_items(documents, items.limit(0)).count() == 0 and leakage.leaked_items(documents.limit(0), items).count() == 0


def test_labels_of_languages(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(v,) for v in ("en_US", " DE ", "German", "fra", "pt-BR", "zh_Hans", "nl", "und", "", None)], "v string")
    assert [r[0] for r in df.select(language.label_code(F.col("v"))).collect()] == ["en", "de", "de", "fr", "pt", "zh", "other", "other", None, None]


def test_sentences_and_prose():
    got = language.sentences("The mean was 7.88 for ORB-12. Die Probe war klar!\n>seq_1\nACDEFGHIKLMNPQRSTVWY\n样品已经保存。第二句话在这里。")
    assert got[0] == "the mean was for" and "die probe war klar" in got and "第二句话在这里" in got and not any("acdefghik" in s for s in got)
    assert not any(language.is_prose(s) for s in language.sentences("12.5\t7.1\n>chain_1\nMKVLAAGIVGLCAKAYELSG (v2)"))


@pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")
def test_held_out_accuracy_and_mixed_texts(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    half = documents.filter("doc_id % 2 = 0")
    model = language.fit(half)
    rest = documents.filter("doc_id % 2 = 1").select("doc_id", "text", language.label_code(documents["lang"]).alias("label")).filter(documents["lang"].isNotNull())
    told = language.text_languages(rest, model, keep=["label"]).filter("label <> 'other' and n_langs = 1").toPandas()
    assert len(told) > 200 and (told["label"] == told["lang_found"]).mean() > 0.9
    english = "The sample was stored in the cold room for several days. The signal of the control was slightly higher than before. "
    german = "Die Probe wurde mehrere Tage lang im Kühlraum aufbewahrt. Das Signal der Kontrolle war etwas höher als vorher. "
    texts = [(1, english * 2), (2, english + german), (3, english * 2 + "Guten Tag, Herr Doktor."), (4, english + german.split(". ")[0] + "."), (5, None), (6, " "), (7, "12 34\n>x\nACDEFGHIKLMNPQRSTVWY"), (8, german * 400)]
    got = language.text_languages(spark.createDataFrame(texts, "doc_id long, text string"), model)
    assert rows(got, "doc_id", "lang_found") == [(1, "en"), (2, "de"), (2, "en"), (3, "en"), (4, "en"), (8, "de")]
    assert all(0 < r["confidence"] <= 1 for r in got.collect())


ENGLISH = "The sample was stored in the cold room for several days. The signal of the control was slightly higher than before. "
GERMAN = "Die Probe wurde mehrere Tage lang im Kühlraum aufbewahrt. Das Signal der Kontrolle war etwas höher als vorher. "


@pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")
def test_segments_short_sentences_and_quotes(spark):
    model = language.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    quoted = "> Die Probe wurde mehrere Tage lang im\n> Kühlraum aufbewahrt. Das Signal der Kontrolle\n> war etwas höher als vorher. "
    texts = [
        (1, ENGLISH * 2 + GERMAN + ENGLISH), (2, ENGLISH + "\n\n" + quoted), (3, ENGLISH + GERMAN.split(". ")[0] + ". Nicht wahr? " + ENGLISH), (4, ">seq_12\n" + ENGLISH + "\n>chain_7\nACDEFGHIKL"),
        (5, ENGLISH + "<a href='" + "x/" * 300 + "'>" + GERMAN + "</a>"), (6, None), (7, ENGLISH + GERMAN.split(". ")[0] + ". " + ENGLISH), (8, ENGLISH.replace(" ", "&nbsp;", 3)),
    ]
    got = language.text_segments(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()
    whole = {i: t for i, t in texts}
    by = {}
    for r in sorted(got, key=lambda r: (r["doc_id"], r["segment"])):
        by.setdefault(r["doc_id"], []).append((r["lang"], whole[r["doc_id"]][r["start"] : r["end"]].split()[0].strip(">")))
    assert [x for x, _ in by[1]] == ["en", "de", "en"] and by[1][1][1] == "Die" and by[1][2][1] == "The"
    assert [x for x, _ in by[2]] == ["en", "de"] and [x for x, _ in by[3]] == ["en", "de", "en"] and [x for x, _ in by[5]] == ["en", "de"]
    assert all([x for x, _ in by[i]] == ["en"] for i in (4, 7, 8)) and 6 not in by
    assert all(0 < r["confidence"] <= 1 and r["letters"] > 0 for r in got)


@pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")
def test_confidence_is_the_share_of_right_answers(spark):
    """Single sentences of held-out texts, told by a model of the other texts."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(documents.filter("doc_id % 2 = 0"))
    rest = documents.filter("doc_id % 2 = 1").select("text", language.label_code(documents["lang"]).alias("label")).filter("label in ('de', 'en', 'es', 'fr', 'it', 'pt', 'ru', 'zh')").collect()
    right, sure = [], []
    for r in rest:
        parts = [p for p in language.sentences(r["text"]) if language.is_prose(p)]
        likelihood = language.scores(parts, model.matrix)
        if parts and language.CODES[int(likelihood.sum(axis=0).argmax())] == r["label"] and len(language.languages_of(parts, likelihood)) == 1:
            post = language.posterior(likelihood, model.temperature)
            right += (post.argmax(axis=1) == language.CODES.index(r["label"])).tolist()
            sure += post.max(axis=1).tolist()
    assert len(right) > 1000 and abs(np.mean(right) - np.mean(sure)) < 0.01


def test_without_labels_no_language_is_told(spark):
    df = spark.createDataFrame([(1, "The sample was stored in the cold room.", None, 1)], "doc_id long, text string, lang string, label int")
    assert language.wrong_labels(df).count() == 0 and language.wrong_labels(df.limit(0)).count() == 0
