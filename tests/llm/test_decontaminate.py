import pytest

from shelfcast.llm import decontaminate
from tests.llm.helpers import UPPER, frame, prose

PASSAGE = prose(1, 40, 10_000)


def words(text):
    out, word = [], ""
    for c in (text or "").translate(UPPER) + " ":
        if c.isascii() and not c.isalnum():
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out


def brute(rows, items, size):
    wanted = {}
    for item, t in items:
        w = words(t)
        if item is not None and w:
            n = min(size, len(w))
            for s in range(len(w) - n + 1):
                wanted.setdefault(tuple(w[s : s + n]), set()).add(str(item))
    out = []
    for d, t in rows:
        w, hit, named = words(t), set(), set()
        for n in {len(k) for k in wanted}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in wanted:
                    hit |= set(range(s, s + n))
                    named |= wanted[tuple(w[s : s + n])]
        out.append((d, len(w), len(hit), sorted(named)))
    return sorted(out, key=repr)


P = PASSAGE.split()
ROWS = [
    (1, PASSAGE),
    (2, prose(2, 600, 10_000) + " " + PASSAGE.upper() + prose(3, 700, 10_000)),
    (3, ", ".join(P[5:18])),
    (4, " ".join(P[5:17])),
    (5, None),
    (6, ""),
    (7, " .,; "),
    (8, "tiny item"),
    (8, "tiny item"),
    (8, "Another text, same id: tiny-item"),
    (None, PASSAGE),
    (9, "ÉTÉ été x " * 30),
    (10, prose(4, 2000, 10_000) + " " + " ".join(P[:13])),
    (11, " ".join(["one"] * 1500)),
    (12, " ".join(P[:20] + P[:20] + P[10:30])),
]
ITEMS = [(1, PASSAGE), (2, "Tiny item!"), (10, " ".join(P[3:30])), (10, " ".join(P[3:30])), (3, None), (4, ""), (5, "..."), (None, "one one"), (6, "été X ÉTÉ été"), (7, "one one one")]


@pytest.mark.parametrize("size", [13, 4])
@pytest.mark.parametrize("bound", [200_000, 3])
def test_hits_equal_brute_force(spark, monkeypatch, size, bound):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", bound)
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.find_contamination(frame(spark, ROWS), benchmark, size=size).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found), key=repr) == brute(ROWS, ITEMS, size)


def test_filter_keeps_clean_rows_and_columns(spark):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = frame(spark, ROWS)
    left = decontaminate.without_contaminated(docs, benchmark)
    assert left.columns == docs.columns
    bad = {(d, n) for d, n, hit, _ in brute(ROWS, ITEMS, 13) if hit and 20 * hit >= n}
    want = sorted((r for r in ROWS if (r[0], len(words(r[1]))) not in bad), key=repr)
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=repr) == want


def test_empty_tables_and_no_python(spark):
    docs, benchmark = frame(spark, ROWS), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.find_contamination(docs.limit(0), benchmark).collect() == []
    assert {r["n_hit"] for r in decontaminate.find_contamination(docs, benchmark.limit(0)).collect()} == {0}
    plan = decontaminate.find_contamination(docs, benchmark)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and not any(x in plan for x in ("Python", "Arrow", "CartesianProduct", "NestedLoop"))
