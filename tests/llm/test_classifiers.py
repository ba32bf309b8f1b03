import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import language, quality, toxicity
from shelfcast.llm.sampling import crc_of
from tests.llm.helpers import frame, prose, words_of

ODD = [(9001, None), (9002, ""), (9003, " \t\n"), (None, "a null id here"), (9004, "x"), (9004, "x"), (9005, "日本 " * 40_000), (9006, "12 34 --")]


def test_crc_is_the_usual_one(spark):
    got = spark.range(5).select(crc_of(F.col("id")).alias("c")).collect()
    assert [r["c"] for r in got] == [zlib.crc32(str(i).encode()) for i in range(5)]


# quality


def brute_counts(text):
    text = text or ""
    words = words_of(text)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    inside = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), len(words) < 50 or 100 * len(inside) > 50 * len(words))


def quality_rows():
    good = [(i, prose(i, 60 + i, 300)) for i in range(80)]
    bad = [(100 + i, " ".join(f"{w.upper()}!!" for w in prose(i, 70, 300).split())) for i in range(80)]
    repeats = [(300, "a b c " * 30), (301, "line one\nline one\n" * 3 + "\n\n"), (302, "a a a a"), (303, "a a a"), (304, "é\n é\né | # <>")]
    return good + bad + repeats + ODD


def test_quality_counts_and_verdicts(spark):
    rows = quality_rows()
    labels = spark.createDataFrame([(i, 1) for i in range(60)] + [(100 + i, 0) for i in range(60)] + [(None, 1), (5, None)], "id long, label int")
    found = quality.score_quality(frame(spark, rows), labels).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = sorted(((r["doc_id"], *(r[n] for n in names)) for r in found), key=repr)
    assert got == sorted(((d, *brute_counts(t)) for d, t in rows), key=repr)
    kept = {r["doc_id"]: (r["kept"], r["good"]) for r in found}
    assert all(kept[i][0] for i in range(60, 80)) and not any(kept[100 + i][0] for i in range(60, 80))
    assert all(not r["kept"] for r in found if r["base_failed"]) and all(0 <= r["good"] <= 1 for r in found)


def test_quality_without_labels_keeps_what_the_base_keeps(spark):
    empty = spark.createDataFrame([], "id long, label int")
    found = quality.score_quality(frame(spark, quality_rows()), empty).collect()
    assert all(r["kept"] != r["base_failed"] for r in found)
    assert quality.score_quality(frame(spark, quality_rows()).limit(0), empty).collect() == []


def test_repeated_words_with_many_distinct_words():
    rng = np.random.default_rng(2)
    numbers = rng.integers(0, 4, 300)
    assert quality.repeated_words(numbers, 4) == quality.repeated_words(numbers, 1 << 21) == brute_counts(" ".join(map(str, numbers)))[4]


def test_platt_gives_the_share_of_ones():
    rng = np.random.default_rng(1)
    margin = rng.normal(size=4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * margin - 1)))).astype(float)
    a, b = quality.fit_platt(margin, y)
    assert abs(a - 2) < 0.3 and abs(b + 1) < 0.2


# language

SYLLABLES = {"aa": ["tha", "ing", "ent", "wor"], "bb": ["ção", "lhe", "ndo", "que"], "cc": ["sch", "üng", "eit", "ver"]}


def spoken(name, seed, n):
    rng = random.Random(f"{name}{seed}")
    return " ".join("".join(rng.choice(SYLLABLES[name]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_language_of_unseen_documents(spark):
    rows = [(k * 100 + i, spoken(name, i, 5 + i)) for k, name in enumerate(SYLLABLES) for i in range(60)]
    known = [(d, list(SYLLABLES)[d // 100]) for d, _ in rows if d % 100 < 40] + [(None, "aa"), (0, None)] + [(40, "cc")]  # one wrong label
    found = language.identify_language(frame(spark, rows + ODD), spark.createDataFrame(known, "id long, label string")).collect()
    assert len(found) == len(rows) + len(ODD)
    by = {r["doc_id"]: r for r in found}
    assert all(by[d]["nearest"] == list(SYLLABLES)[d // 100] for d, _ in rows)
    assert all(0 <= r["score"] <= 1 for r in found)
    for d in (9001, 9002, 9003, 9006):
        assert by[d]["nearest"] is None and by[d]["score"] == 0 and by[d]["rejected"]
    assert by[9005]["nearest"] in SYLLABLES and by[9005]["rejected"]  # far from every centroid


def test_language_without_anything_learnt(spark):
    empty = spark.createDataFrame([], "id long, label string")
    assert {r["nearest"] for r in language.identify_language(frame(spark, ODD), empty).collect()} == {None}
    assert language.identify_language(frame(spark, ODD).limit(0), empty).collect() == []


# toxicity


def toxic_rows():
    rng = random.Random(4)
    clean = [(i, prose(i, 30 + i % 50, 200)) for i in range(150)]
    bad = []
    for i in range(60):
        words = prose(500 + i, 40, 200).split()
        for _ in range(3):
            words.insert(rng.randrange(len(words)), rng.choice(["vilest", "grubby", "nastiness"]))
        bad.append((200 + i, " ".join(words)))
    return clean, bad


def test_toxic_documents_are_found_and_clean_ones_left(spark):
    clean, bad = toxic_rows()
    labels = spark.createDataFrame([(d, 0) for d, _ in clean[:100]] + [(d, 1) for d, _ in bad[:40]] + [(None, 1), (3, None), (4, 7)], "id long, label int")
    found = toxicity.score_toxicity(frame(spark, clean + bad + ODD), labels).collect()
    assert len(found) == len(clean) + len(bad) + len(ODD)
    score = {r["doc_id"]: r["score"] for r in found}
    assert all(score[d] >= 0.5 for d, _ in bad) and all(score[d] < 0.5 for d, _ in clean + ODD)
    assert all(0 <= r["score"] <= 1 for r in found)
    seen = next(r for r in found if r["doc_id"] == 259)
    assert len(seen["evidence"]) == 3 and {e["label"] for e in seen["evidence"]} == {1}
    assert seen["row"]["score"] == "x"
    none = spark.createDataFrame([], "id long, label int")
    assert {r["score"] for r in toxicity.score_toxicity(frame(spark, bad), none).collect()} == {0.0}
    assert toxicity.score_toxicity(frame(spark, bad).limit(0), labels).collect() == []


@pytest.mark.parametrize("near", [False, True])
def test_toxic_copies_do_not_push_out_the_terms_of_others(spark, near):
    clean, bad = toxic_rows()
    hot = prose(999, 60, 200) + " cursed drivel"
    copies = [(1000 + i, hot + (f" n{i}" if near else "")) for i in range(2400)]
    rare = [(d, t.replace("vilest", "scummy").replace("grubby", "scummy").replace("nastiness", "scummy")) for d, t in bad[:20]]
    labels = spark.createDataFrame([(d, 0) for d, _ in clean[:100]] + [(d, 1) for d, _ in rare[:12] + copies[:2000]], "id long, label int")
    found = toxicity.score_toxicity(frame(spark, clean + rare + copies), labels, sample_rows=1200).collect()
    score = {r["doc_id"]: r["score"] for r in found}
    assert all(score[d] >= 0.5 for d, _ in rare[12:]) and all(score[d] < 0.5 for d, _ in clean)


def test_copies_of_toxic_examples_are_toxic(spark):
    clean, bad = toxic_rows()
    odd = [(400, "x" * 90), (401, " ".join(f"own{c}" for c in "abcdefgh")), (402, "\u4e2d" * 70 + " " + prose(78, 12, 200))]  # words of one example
    labels = spark.createDataFrame([(d, 0) for d, _ in clean[:100]] + [(d, 1) for d, _ in bad[:40] + odd], "id long, label int")
    copies = [(1000 + d, t) for d, t in bad[:40] + odd]
    score = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(frame(spark, clean + bad + odd + copies), labels).collect()}
    assert all(score[d] >= 0.5 for d, _ in copies) and all(score[d] < 0.5 for d, _ in clean)


def test_a_batch_of_searches_equals_single_ones():
    rng = random.Random(8)
    vectors = [{t: rng.random() for t in rng.sample(range(90), rng.randint(0, 9))} for _ in range(300)]
    index = toxicity.Index.build(vectors, 90)
    for i, found in enumerate(index.nearest_all(vectors, 7, list(range(300)))):
        assert [s for _, s in found] == pytest.approx([s for _, s in index.nearest(vectors[i], 7, i)], abs=1e-5) and i not in {e for e, _ in found}
    assert toxicity.Index.build([], 3).nearest({1: 1.0}, 2) == []


@pytest.mark.parametrize("k", [1, 5, 40])
def test_block_max_search_is_exact(k):
    rng = random.Random(k)

    def unit():
        v = {t: rng.random() for t in rng.sample(range(50), rng.randint(1, 8))}
        n = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / n for t, x in v.items()}

    vectors = [unit() for _ in range(500)]
    index = toxicity.Index.build(vectors, 50)
    for out in (-1, 3):
        for _ in range(30):
            q = unit()
            cosines = [(i, sum(x * v.get(t, 0) for t, x in q.items())) for i, v in enumerate(vectors) if i != out]
            want = sorted((c for _, c in cosines if c > 0), reverse=True)[:k]
            assert [c for _, c in index.nearest(q, k, out)] == pytest.approx(want, abs=1e-5)
    assert index.nearest({}, 3) == []
