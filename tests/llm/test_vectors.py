import math

import numpy as np
import pytest

from shelfcast.llm import topk
from shelfcast.llm.topk import top_inner_products
from shelfcast.llm.vectors import packed, unpacked
from shelfcast.llm.whitening import cross_products, limbs, whiten

SCHEMA = "vec_id long, embedding array<float>, x int, score string, n long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "s", 2) for i, v in rows], SCHEMA)


def odd_rows():
    return [(9001, None), (9002, [1.0, None, 0.0]), (9003, [float("nan"), 0.0, 0.0]), (9004, [float("inf"), 0.0, 0.0]), (9005, [1.0]), (9006, [])]


@pytest.mark.parametrize("top", [3, 100, 30_000, 1 << 40, 1 << 62])
def test_packing_is_reversible_and_equal_for_equal_rows(top):
    import pyarrow as pa

    x = np.random.default_rng(1).integers(-top, top, (50, 4))
    x[7] = x[3]
    rows = packed(x)
    assert rows[7] == rows[3]
    assert (unpacked(pa.array(rows), 4) == x).all()


@pytest.mark.parametrize("low,high,rows", [(-146, 146, 9000), (0, 1, 5), (-(2**62), 2**62, 70), (-(2**63), 2**63 - 1, 3)])
def test_cross_products_from_bit_planes_are_exact(low, high, rows):
    x = np.random.default_rng(2).integers(low, high, (rows, 5), endpoint=True)
    plain = x.astype(object).T.dot(x.astype(object))
    assert (cross_products(x) == np.triu(plain)).all()
    for v in [*plain.ravel(), -1, 0, -(2**126)]:
        assert sum(part << (32 * i) for i, part in enumerate(limbs(int(v)))) == v


def plain_whitening(rows):
    x = [(i, np.floor(256 * np.array(v, dtype=np.float32).astype(float)).astype(int)) for i, v in rows]
    fit = np.unique(np.array([v for _, v in x]), axis=0)
    n, total = len(fit), fit.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(fit.T.astype(float), bias=True))
    white = {(i, c + 1): (v - total / n) @ vectors[:, -1 - c] / math.sqrt(values[-1 - c]) for i, v in x for c in range(fit.shape[1])}
    return n, {i: int(((n * v - total) ** 2).sum()) for i, v in x}, white, values[::-1] / values.sum()


def test_whitening_equals_a_plain_fit_and_leaves_out_unfit_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(a), float(2 * b + a), float(0.1 * c)]) for i, (a, b, c) in enumerate(rng.normal(size=(300, 3)))]
    rows += [(1000 + i, rows[0][1]) for i in range(400)]  # copies count once
    rows += [(None, rows[1][1]), (2, rows[2][1])]
    n, deviation, white, explained = plain_whitening(rows)
    got = whiten(frame(spark, rows + odd_rows()), components=None).collect()
    assert len(got) == 3 * len(rows)
    assert {r["n"] for r in got} == {n}
    assert max(r["identity_error"] for r in got) < 1e-9
    for c in (1, 2, 3):
        part = [r for r in got if r["component"] == c]
        assert abs(part[0]["explained"] - explained[c - 1]) < 1e-12
        signs = {round(r["whitened"] / white[r["vec_id"], c]) for r in part}
        assert signs in ({1}, {-1})
        assert all(abs(abs(r["whitened"]) - abs(white[r["vec_id"], c])) < 1e-9 for r in part)
        assert all(int(r["deviation"]) == deviation[r["vec_id"]] for r in part)


def test_whitening_of_few_equal_or_huge_vectors(spark):
    assert whiten(frame(spark, [])).collect() == []
    assert whiten(frame(spark, odd_rows()[:1])).collect() == []
    same = whiten(frame(spark, [(1, [0.5, -0.5]), (2, [0.5, -0.5])])).collect()
    assert sorted((r["vec_id"], r["component"], r["n"], int(r["deviation"]), r["whitened"], r["explained"], r["identity_error"]) for r in same) == [
        (i, c, 1, 0, 0.0, 0.0, 0.0) for i in (1, 2) for c in (1, 2)
    ]
    huge = whiten(frame(spark, [(1, [3e38, 0.0]), (2, [-3e38, 0.0]), (3, [1.0, 2.0])])).collect()
    assert len(huge) == 6
    assert all(math.isfinite(r["whitened"]) for r in huge)


def plain_top(asked, offered, k):
    x = lambda v: np.floor(1024 * np.array(v, dtype=np.float32).astype(float)).astype(object)
    best = {}
    for i, q in asked:
        best.setdefault(i, []).extend((-int(x(q) @ x(v)), j) for j, v in offered if j != i)
    return sorted((i, r + 1, j, -s) for i, found in best.items() for r, (s, j) in enumerate(sorted(found)[:k]))


@pytest.mark.parametrize("seed", range(4))
def test_search_equals_brute_force(spark, monkeypatch, seed):
    """Small blocks and slices, lengths of three magnitudes, copies and ties of a third of the rows."""
    monkeypatch.setattr(topk, "BLOCK_PAIRS", 64)
    monkeypatch.setattr(topk, "GROUP_BYTES", 8 * 3 * 5)
    monkeypatch.setattr(topk, "SLICE_ROWS", 40)
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(400, 3)) * rng.choice([0.01, 1, 3000], (400, 1)))]
    rows += [(1000 + i, rows[5][1]) for i in range(200)] + [(7, rows[8][1])] * 3
    asked = [r for r in rows if r[0] % 40 == 0]
    extra = [*odd_rows(), (None, [1.0, 1.0, 1.0])]
    got = top_inner_products(frame(spark, asked + extra), frame(spark, rows + extra), k=4).collect()
    assert sorted(tuple(r) for r in got) == plain_top(asked, rows, 4)


def test_search_with_wide_spectra_prunes_and_stays_exact(spark, monkeypatch):
    rng = np.random.default_rng(9)
    scored = []
    plain = topk.Cell._scores
    monkeypatch.setattr(topk.Cell, "_scores", lambda self, q, *rest: scored.append(len(q)) or plain(self, q, *rest))
    x = np.floor(1024 * rng.normal(size=(6000, 32)) * 0.6 ** np.arange(32)).astype(np.int64)
    x = x[np.argsort(-(x**2).sum(axis=1), kind="stable")]
    turn = np.linalg.svd(x.astype(float))[2].T
    cell = topk.Cell(np.arange(20), x[:20], turn, 10)
    cell.size = 500
    cell.see(np.arange(6000), x)
    q, c, s = cell.rows()
    full = x[:20] @ x.T
    for i in range(20):
        order = [j for j in np.lexsort((np.arange(6000), -full[i])) if j != i][:10]
        assert sorted(c[q == i]) == sorted(order)
        assert sorted(s[q == i]) == sorted(full[i][order])
    assert sum(scored[1:]) < 0.2 * 20 * 5500


def test_search_of_few_rows(spark):
    one = [(100, [1.0, 0.0])]
    assert top_inner_products(frame(spark, one), frame(spark, one)).collect() == []
    assert top_inner_products(frame(spark, []), frame(spark, one)).collect() == []
    assert top_inner_products(frame(spark, one), frame(spark, [])).collect() == []
    two = [*one, (3, [0.0, 2.0]), (4, [3e38, 3e38])]
    assert [tuple(r) for r in top_inner_products(frame(spark, one), frame(spark, two)).collect()] == [(100, 1, 3, 0)]
