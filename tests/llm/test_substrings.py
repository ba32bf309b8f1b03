import pytest

from shelfcast.llm import substrings
from tests.llm.helpers import frame, prose, words_of


def brute(rows, length):
    seen, out = {}, []
    texts = sorted({(d, t or "") for d, t in rows if d is not None})
    for d, t in texts:
        w = words_of(t)
        for s in range(len(w) - length + 1):
            key = tuple(w[s : s + length])
            seen[key] = min(seen.get(key, (d, s)), (d, s))
    for d, t in rows:
        w = words_of(t)
        gone = set()
        for s in range(len(w) - length + 1) if d is not None else []:
            if seen[tuple(w[s : s + length])] < (d, s):
                gone |= set(range(s, s + length))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


PASSAGE = prose(1, 30, 1000)
ROWS = (
    [(i, f"{prose(100 + i, 15, 1000)} {PASSAGE}\n{prose(200 + i, 9, 1000)}") for i in range(1, 12)]
    + [(20, PASSAGE), (21, PASSAGE), (21, PASSAGE), (22, f"{PASSAGE} x {PASSAGE}"), (23, " ".join(PASSAGE.split()[:20])), (24, " ".join(PASSAGE.split()[:19]))]
    + [(30, None), (31, ""), (32, " \t\n"), (None, PASSAGE), (33, "a " * 400), (34, "a b " * 100), (35, "a " * 25)]
    + [(40, prose(5, 900, 3)), (41, prose(6, 700, 2)), (42, prose(5, 450, 3)), (43, "É é x " * 30)]
)


@pytest.mark.parametrize("length", [20, 8, 4])
def test_kept_words_equal_brute_force(spark, length):
    left = substrings.remove_repeats(frame(spark, ROWS), length=length)
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in left.collect()), key=repr) == brute(ROWS, length)


def test_empty_table(spark):
    assert substrings.remove_repeats(frame(spark, ROWS).limit(0)).collect() == []


def test_equal_windows_have_equal_anchors_and_blocks_cover_all_windows():
    text = [prose(9, 500, 3).encode(), prose(10, 19, 5).encode(), b"", (PASSAGE + " " + PASSAGE).encode()]
    words = substrings.Words(text)
    first, last, anchor, owner = substrings.blocks_of(words, 20)
    covered = [s for a, b in zip(first, last) for s in range(a, b + 1)]
    assert covered == [words.starts[k] + s for k, n in enumerate(words.counts) for s in range(n - 19)]
    flat = [w for t in text for w in t.split()]
    by_window = {}
    for a, b, g in zip(first, last, anchor):
        for s in range(a, b + 1):
            assert by_window.setdefault(tuple(flat[s : s + 20]), g) == g
