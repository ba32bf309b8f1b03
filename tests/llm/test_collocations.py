import random
import re
from collections import Counter

import numpy as np
import pytest

from shelfcast.llm import collocations
from shelfcast.llm.collocations import Bitmap, frequent_bitmap, mine_collocations, text_slices
from shelfcast.llm.fm_index import FmIndex
from tests.llm.helpers import UPPER


@pytest.mark.parametrize("seed,symbols,context", [(0, 4, 0), (1, 30, 0), (2, 3, 4), (3, 2, 3), (4, 6, 2)])
def test_index_counts_every_phrase_in_both_directions(seed, symbols, context):
    text = np.random.default_rng(seed).integers(0, symbols, 500)
    index, depth = FmIndex(text, symbols, 5), 5
    for words, count in index.phrases(context):
        m = words.shape[1]
        plain = Counter(tuple(text[i : i + m].tolist()) for i in range(len(text) - m + 1) if i + m > context)
        found = {tuple(w): c for w, c in zip(words.tolist(), count.tolist(), strict=True) if c}
        assert found == {w: c for w, c in plain.items() if 0 not in w}
    left = index.extend_left(index.single())
    right = index.extend_right(index.single())
    table = lambda p: sorted(zip(map(tuple, p.words.tolist()), p.lo.tolist(), p.back.tolist(), p.count.tolist(), strict=True))
    assert table(left) == table(right)
    assert depth == index.depth


def test_index_of_nothing():
    assert [len(w) for w, _ in FmIndex(np.zeros(0, dtype=np.int64), 1, 5).phrases()] == [0] * 5


@pytest.mark.parametrize("text", [b"", b"a", b"abc def  gh\nij", b"x" * 50 + b" y", b"a b c d e f g h i j " * 9])
def test_slices_cut_no_word(text):
    for limit in (1, 3, 8, 1000):
        parts = list(text_slices(text, limit))
        assert b"".join(parts) == text
        assert [w for p in parts for w in p.split()] == text.split()


def plain(rows, least, longest, top):
    found, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            words = re.findall(r"[^ \t]+", piece)
            total[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    found[lang, tuple(words[i : i + m])] += 1
    often = {p: f for p, f in found.items() if f >= least}
    covered = {(lang, w[s : s + k]) for (lang, w), f in often.items() for k in range(1, len(w)) for s in range(len(w) - k + 1) if often[lang, w[s : s + k]] <= f}
    out = []
    for (lang, w), a in often.items():
        if len(w) > 1 and (lang, w) not in covered:
            cuts = [(1000 * a * total[lang] // (found[lang, w[:k]] * found[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out.append((lang, -score, -a, " ".join(w).encode(), found[lang, w[:k]], found[lang, w[k:]], total[lang]))
    ranked, place = [], Counter()
    for lang, score, a, phrase, left, right, n in sorted(out):
        place[lang] += 1
        if place[lang] <= top:
            ranked.append((lang, place[lang], phrase.decode(), -a, left, right, n, -score))
    return sorted(ranked)


def mixed(seed, size):
    rng = random.Random(seed)
    words = ["a", "B", "b", "Été", "été", "c\u0000d", "x-y", "日本", "z", " "]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "\x0b", " "]) for _ in range(n))
    rows = [(rng.choice(["en", "en", "en", "de", None, "und", "", "A"]), text(rng.randrange(30))) for _ in range(size)]
    rows += [("en", "one two three four five six"), ("de", None), ("fr", ""), ("fr", " .,\t")] * 8
    return [*rows, ("en", text(5000)), ("en", "w " * 3000), ("de", "v" * 3000 + " u v u v")]


@pytest.mark.parametrize("seed,words,piece,longest,top", [(0, 1 << 20, 1 << 20, 5, 2000), (1, 50, 40, 5, 2000), (2, 7, 9, 4, 12), (3, 200, 64, 3, 2000)])
def test_equals_brute_force_for_every_shard_size(spark, monkeypatch, seed, words, piece, longest, top):
    monkeypatch.setattr(collocations, "SHARD_WORDS", words)
    monkeypatch.setattr(collocations, "SLICE_BYTES", piece)
    monkeypatch.setattr(collocations, "RANK_ROWS", 20)
    rows = mixed(seed, 150 if words > 10 else 40)
    docs = spark.createDataFrame([(t, lang, "x", 1, 2) for lang, t in rows], "text string, lang string, phrase string, n int, a int").repartition(3)
    got = sorted(tuple(r) for r in mine_collocations(docs, least=6, longest=longest, top=top).collect())
    assert got == plain(rows, 6, longest, top)
    assert len({r[0] for r in got}) >= (2 if words > 10 else 1)


def test_products_beyond_64_bits_are_exact(spark):
    a, n, left, right = 9 * 10**11, 8 * 10**15 + 1, 10**12 + 7, 10**13 + 9
    one = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    assert one.select(collocations._score(*[one[c] for c in "anlr"])).first()[0] == 1000 * a * n // (left * right)


def test_tables_without_words(spark):
    none = spark.createDataFrame([], "text string, lang string")
    assert mine_collocations(none).collect() == []
    assert mine_collocations(spark.createDataFrame([(None, None), ("", "en"), ("rare words only", "en")], "text string, lang string")).collect() == []


@pytest.mark.parametrize("least_bits", [15, 23])
def test_bitmap_holds_every_frequent_hash(spark, monkeypatch, least_bits):
    monkeypatch.setattr(collocations, "LEAST_BITS", least_bits)
    hashes = np.random.default_rng(5).integers(-(2**63), 2**63, 3000)
    rows = [(int(h), 2 + i % 2) for i, h in enumerate(hashes) for _ in range(2)] + [(0, 9), (-1, 9)]
    power, bits = frequent_bitmap(spark.createDataFrame(rows, "hash long, n long"), 5)
    found = Bitmap(power, np.frombuffer(bits, dtype=np.uint8)).has(hashes.view(np.uint64))
    assert found[1::2].all()
    assert found[::2].mean() < 0.1
    assert Bitmap(power, np.frombuffer(bits, dtype=np.uint8)).has(np.array([0, 2**64 - 1], dtype=np.uint64)).all()


def test_colliding_hashes_change_nothing(spark, monkeypatch):
    """Bitmaps of eight bits let nearly all words and pairs pass, the sums decide."""
    monkeypatch.setattr(collocations, "LEAST_BITS", 3)
    monkeypatch.setattr(collocations, "MOST_BITS", 3)
    rows = mixed(4, 60)
    docs = spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string")
    assert sorted(tuple(r) for r in mine_collocations(docs, least=6).collect()) == plain(rows, 6, 5, 2000)
