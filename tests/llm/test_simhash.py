import numpy as np
import pytest
import xxhash

from shelfcast.llm import simhash
from shelfcast.llm.components import components


def roots(nodes, pairs):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


TEXTS = [None, "", "  \t\n ", "One", "one two", "A b C", "a b c a b c a b c", "é Ü x y", "w " * 70000, " ".join(map(str, range(3000)))]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint_equals_the_definition(text):
    assert simhash.fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("home,visit", [(4096, 65536), (3, 4)])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, home, visit):
    monkeypatch.setattr(simhash, "HOME_ROWS", home)
    monkeypatch.setattr(simhash, "VISIT_ROWS", visit)
    rng = np.random.default_rng(7)
    fps = [int(x) for x in rng.integers(0, 1 << 64, 60, dtype=np.uint64)] + [0, (1 << 64) - 1, 1 << 63]
    for base in fps[:25]:
        for _ in range(12):  # chains: steps of one or two bits
            base ^= 1 << int(rng.integers(64))
            base ^= 1 << int(rng.integers(64))
            fps.append(base)
    fps += [int(x) & ~3 | i for x in fps[:4] for i in range(4)]
    fps = sorted(set(fps))
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    links = simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()
    near = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2]
    for x, y in links:
        assert x != y and ((x ^ y) & ((1 << 64) - 1)).bit_count() <= 64
    assert roots(signed, [tuple(r) for r in links]) == roots(signed, near)


def test_components_of_a_path_a_star_and_a_ring(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200)] + [(5, 5)]
    frame = spark.createDataFrame(pairs + [(None, 3)], "x long, y long")
    got = {r["node"]: r["component"] for r in components(frame).collect()}
    want = roots({n for p in pairs for n in p}, pairs)
    assert got == want


def test_documents_with_nulls_copies_and_clashing_columns(spark):
    rows = [(1, "a b c d", "x", 1), (2, "A B c d", "y", 2), (2, "A B c d", "y", 2), (3, None, None, 3), (4, "", "z", 4), (9, "other words here", "q", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    got = sorted((r["doc_id"], r["component_id"]) for r in simhash.simhash_components(frame).collect())
    assert got == [(1, 1), (2, 1), (2, 1), (3, 3), (4, 3), (9, 9)]
    assert simhash.simhash_components(frame.limit(0)).collect() == []
