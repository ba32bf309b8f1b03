import hashlib

import numpy as np
import pyarrow as pa
import pytest

from shelfcast.llm import lines
from shelfcast.llm.common import arrow_schema
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tests.llm.helpers import BLANKS, UPPER, frame

LONG = "this line is long enough to count"


def brute(rows, least=20, documents=3):
    holders = {}
    key = lambda line: line.strip(BLANKS).translate(UPPER)
    for d, t in rows:
        for line in (t or "").split("\n") if d is not None else []:
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(d)
    out = []
    for d, t in rows:
        split = (t or "").split("\n")
        kept = [x for x in split if d is None or len(holders.get(key(x), ())) < documents or d == max(holders[key(x)])]
        out.append((d, len(split), len(split) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


ROWS = (
    [(i, f"{LONG}\nown line of document number {i} here\n{LONG.upper()}  \nshort") for i in range(1, 30)]
    + [(40, None), (41, ""), (42, "\n\n"), (43, LONG), (43, LONG), (44, "two documents share this line"), (45, "two documents share this line\n" * 3)]
    + [(46, "ÄÖÜ" * 7), (47, "\t" + "ÄÖÜ" * 7), (48, "äöü" * 7), (49, "ÄÖÜ" * 7), (None, LONG), (50, "x" * 300_000 + "\n" + LONG), (51, "é" * 19), (52, "é" * 19), (53, "é" * 19)]
    + [(60, "same id, first text of two, long\n" + LONG), (60, "same id, other text of two, long")]
)


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_kept_lines_equal_brute_force(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        docs = frame(spark, ROWS)
        left = lines.keep_lines(docs, lines.line_bitmaps(docs))
        got = sorted(((r["row"]["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in left.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert got == brute(ROWS)


def test_empty_table(spark):
    docs = frame(spark, ROWS).limit(0)
    assert lines.keep_lines(docs, lines.line_bitmaps(docs)).collect() == []


@pytest.mark.parametrize("cuts", [1, 2, 7, 60])
def test_stream_settles_runs_cut_anywhere(cuts):
    """Keys in sorted order, cut into tasks and batches at any row: what tasks decide and what they leave open add up."""
    rng = np.random.default_rng(cuts)
    rows = sorted({(int(k), int(d), int(p)) for k, d, p in rng.integers(0, [6, 12, 2], (150, 3))}, key=lambda r: (r[0], -r[1], r[2]))
    names = ("h1", "h2", "doc_id", "place", "docs")
    schema = arrow_schema([(n, T.LongType()) for n in names] + [("state", T.IntegerType())])
    # a document's lines of one key stay in one task, as the range partitioning keeps them
    allowed = [i for i in range(1, len(rows)) if rows[i][:2] != rows[i - 1][:2]]
    edges = [0, *sorted(rng.choice(allowed, size=min(cuts - 1, len(allowed)), replace=False).tolist()), len(rows)]
    lost, open_rows, sums = set(), [], {}
    for a, b in zip(edges, edges[1:]):
        task = rows[a:b]
        batches = [task[i : i + 4] for i in range(0, len(task), 4)]
        read = (pa.RecordBatch.from_arrays([pa.array([r[0] for r in x]), pa.array([0 for _ in x]), pa.array([r[1] for r in x]), pa.array([r[2] for r in x])], names=names[:4]) for x in batches)
        for out in lines._stream(read, schema, 2):
            for h1, _, doc, place, docs, state in zip(*[c.to_pylist() for c in out.columns]):
                if state == lines.DROP:
                    lost.add((h1, doc, place))
                else:
                    n, top = sums.get(h1, (0, -1))
                    sums[h1] = (n + docs, max(top, doc))
                    if state == lines.OPEN:
                        open_rows.append((h1, doc, place))
    lost |= {r for r in open_rows if sums[r[0]][0] >= 3 and r[1] < sums[r[0]][1]}
    holders = {}
    for k, d, _ in rows:
        holders.setdefault(k, set()).add(d)
    assert lost == {r for r in rows if len(holders[r[0]]) >= 3 and r[1] < max(holders[r[0]])}


def test_bitmaps_only_for_documents_that_lose_lines(spark):
    docs = frame(spark, ROWS)
    found = {r["doc_id"] for r in lines.line_bitmaps(docs).collect()}
    assert found == {r[0] for r in brute(ROWS) if r[2]}
    digest = hashlib.sha256(b"").hexdigest()
    only = frame(spark, [(1, LONG), (2, LONG), (3, LONG)])
    left = lines.keep_lines(only, lines.line_bitmaps(only)).select("row.doc_id", F.sha2("kept", 256).alias("h"))
    assert {r["doc_id"]: r["h"] == digest for r in left.collect()} == {1: True, 2: True, 3: False}
