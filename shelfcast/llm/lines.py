"""Line dedup: hashes of lines, range-partitioned and streamed in order, give a keep bitmap per document.

Only hashes, ids and positions are shuffled by line. The ranges are cut by hash and document, so a line that a third
of all documents holds is spread over many tasks; what a task cannot know of the lines at its two ends is settled
from one small sum per end.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import BLANKS, arrow_schema, batch_of, byte_chunks, document_rows, giving_back, ids_and_texts, spark_schema, written

DROP, OPEN, SEEN = 0, 1, 2


def line_keys(text: bytes, least: int) -> tuple[list[int], list[bytes]]:
    """Positions and keys of the lines whose key has ``least`` code points or more."""
    blanks = BLANKS.encode()
    at, keys = [], []
    for i, line in enumerate(text.lower().split(b"\n")):
        key = line.strip(blanks)
        if len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least):
            at.append(i)
            keys.append(key)
    return at, keys


def line_hashes(df: DataFrame, least: int) -> DataFrame:
    """(h1, h2, doc_id, place) of every long line of (doc_id, text): a 128-bit hash, and crc32 of the text above the position."""
    fields = [("h1", T.LongType()), ("h2", T.LongType()), ("doc_id", df.schema["doc_id"].dataType), ("place", T.LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        schema, digest = arrow_schema(fields), xxhash.xxh3_128_digest
        for batch in batches:
            for ids, texts in byte_chunks(batch):
                owner, places, hashes = [], [], []
                for k, t in enumerate(texts):
                    at, keys = line_keys(t or b"", least)
                    owner += [k] * len(at)
                    hashes += map(digest, keys)
                    mark = zlib.crc32(t or b"") << 32
                    places += [mark | i for i in at]
                both = np.frombuffer(b"".join(hashes), dtype="<i8").reshape(-1, 2)
                place = np.array(places, dtype=np.uint64).view(np.int64)
                yield batch_of(schema, both[:, 0], both[:, 1], ids.take(pa.array(owner, type=pa.int64())), place)

    return df.mapInArrow(giving_back(run), spark_schema(fields))


def _stream(batches: Iterator[pa.RecordBatch], schema: pa.Schema, most: int) -> Iterator[pa.RecordBatch]:
    """Rows of (h1, h2, doc_id falling, place) in order -> what to drop (DROP), and what the neighbours must settle.

    The first document of a line keeps it; once more than ``most`` documents hold it, the others drop it. The first
    run of a task may have begun in an earlier one: its rows are OPEN. The last may go on: its undecided rows are
    OPEN, and if others were decided, a SEEN row tells how many documents there were and the first of them.
    Memory: a batch, and the undecided rows of one run, which are those of ``most`` documents at most.
    """
    none = np.zeros(0, dtype=np.int64)
    key, first_run, docs, last, top = None, True, 0, None, None
    held_doc, held_place, held_order = none, none, none

    def rows(h1, h2, doc, place, count, state):
        n = len(doc)
        whole = lambda x: np.full(n, x, dtype=np.int64) if np.isscalar(x) else x
        return batch_of(schema, whole(h1), whole(h2), doc, whole(place), whole(count), np.full(n, state, dtype=np.int32))

    for batch in batches:
        h1, h2, doc, place = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        n = len(doc)
        if not n:
            continue
        new_run = np.empty(n, dtype=bool)
        new_run[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new_run[0] = key != (h1[0], h2[0])
        new_doc = new_run.copy()
        new_doc[1:] |= doc[1:] != doc[:-1]
        new_doc[0] |= doc[0] != last
        if new_run[0] and key is not None:
            first_run, held_doc, held_place, held_order, docs = False, none, none, none, 0
        if new_run[0]:
            docs, top = 0, doc[0]
        starts = np.flatnonzero(new_run)
        if not new_run[0]:
            starts = np.concatenate([[0], starts])
        ends = np.concatenate([starts[1:], [n]])
        count = np.cumsum(new_doc)
        run = np.repeat(np.arange(len(starts)), ends - starts)
        base = np.where(starts > 0, count[starts - 1], 0)
        base[0] -= docs
        order = count - base[run]
        total = order[ends - 1]
        drop = (order > 1) & (total[run] > most)
        if first_run:  # the task's first run goes on, or is this batch's first
            drop[: ends[0]] = False
            yield rows(h1[: ends[0]], h2[: ends[0]], doc[: ends[0]], place[: ends[0]], new_doc[: ends[0]].astype(np.int64), OPEN)
        elif total[0] > most and len(held_doc):
            late = held_order > 1
            yield rows(h1[0], h2[0], held_doc[late], held_place[late], 0, DROP)
            held_doc, held_place, held_order = none, none, none
        if drop.any():
            yield rows(h1[drop], h2[drop], doc[drop], place[drop], 0, DROP)
        if len(starts) > 1:
            first_run, held_doc, held_place, held_order = False, none, none, none
            top = doc[starts[-1]]
        if not first_run and total[-1] <= most:
            tail = slice(int(starts[-1]), n)
            held_doc, held_place, held_order = (np.concatenate([a, b[tail]]) for a, b in ((held_doc, doc), (held_place, place), (held_order, order)))
        key, docs, last = (h1[-1], h2[-1]), int(total[-1]), doc[-1]
    if key is None or first_run:
        return
    if docs > most:
        yield rows(key[0], key[1], np.array([top]), 0, docs, SEEN)
    else:
        fresh = np.concatenate([[True], held_order[1:] != held_order[:-1]])
        yield rows(key[0], key[1], held_doc, held_place, fresh.astype(np.int64), OPEN)


def line_bitmaps(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 20, documents: int = 3) -> DataFrame:
    """(doc_id, mark, bitmap): zlib-compressed bits, 1 for a line to keep, of each document that loses lines.

    Lines are split at newlines. A line's key is without blanks at its ends and A-Z lower-cased. Keys of ``least``
    code points found in ``documents`` documents or more stay in the largest id only. Bits beyond the last lost
    line are left out and mean keep. ``mark`` is the text's crc32: rows that share an id but not the text are told
    apart, but count as one document. Rows with a null id neither count nor lose lines; ids must be whole numbers.
    """
    docs = document_rows(df, id_col, text_col).where("doc_id is not null").withColumn("doc_id", F.col("doc_id").cast("long"))
    hashes = written(line_hashes(docs, least), "lines")
    fields = [(n, T.LongType()) for n in ("h1", "h2", "doc_id", "place", "docs")] + [("state", T.IntegerType())]
    order = ["h1", "h2", F.desc("doc_id")]
    dealt = hashes.repartitionByRange(*order).sortWithinPartitions(*order, "place")
    streamed = dealt.mapInArrow(giving_back(lambda batches: _stream(batches, arrow_schema(fields), documents - 1)), spark_schema(fields))
    marked = written(streamed, "marked")
    ends = marked.where(F.col("state") != DROP).groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("doc_id").alias("top"))
    often = F.broadcast(ends.where(F.col("docs") >= documents).select("h1", "h2", "top"))  # two lines a task at most
    settled = marked.where(F.col("state") == OPEN).join(often, ["h1", "h2"]).where("doc_id < top")
    lost = marked.where(F.col("state") == DROP).select("doc_id", "place").unionAll(settled.select("doc_id", "place"))
    mark, at = F.shiftrightunsigned("place", 32), F.col("place").bitwiseAND(F.lit((1 << 32) - 1)).cast("long")
    grouped = lost.select("doc_id", mark.alias("mark"), at.alias("at")).groupBy("doc_id", "mark").agg(F.collect_set("at").alias("lines"))
    out = [("doc_id", T.LongType()), ("mark", T.LongType()), ("bitmap", T.BinaryType())]

    def pressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(out)
        for batch in batches:
            maps = []
            for lines in batch.column(2):
                lines = lines.values.to_numpy(zero_copy_only=False)
                keep = np.ones(int(lines.max()) // 8 * 8 + 8, dtype=np.uint8)
                keep[lines] = 0
                maps.append(zlib.compress(np.packbits(keep).tobytes()))
            yield batch_of(schema, batch.column(0), batch.column(1), maps)

    return grouped.mapInArrow(giving_back(pressed), spark_schema(out))


def keep_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with all its columns in a struct ``row``, and (n_lines, n_dropped, kept) of its text.

    A null or empty text is one empty line; ``kept`` has the lines left, joined by newlines.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.struct("*").alias("row"), F.crc32(text.cast("binary")).alias("crc"))
    with_maps = rows.join(bitmaps, (rows["id"] == bitmaps["doc_id"]) & (rows["crc"] == bitmaps["mark"]), "left")
    source = with_maps.select("id", "row", "bitmap")
    fields = [("row", rows.schema["row"].dataType), ("n_lines", T.LongType()), ("n_dropped", T.LongType()), ("kept", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(fields)
        for batch in batches:
            counts, lost, kept = [], [], []
            for text, bits in zip(ids_and_texts(batch, text_col).column(1), batch.column(2).to_pylist(), strict=True):
                text = text.as_py() or ""
                n = text.count("\n") + 1
                if bits is None:
                    counts.append(n)
                    lost.append(0)
                    kept.append(text)
                    continue
                keep = np.unpackbits(np.frombuffer(zlib.decompress(bits), dtype=np.uint8))
                lines = text.split("\n")
                left = [line for i, line in enumerate(lines) if i >= len(keep) or keep[i]]
                counts.append(n)
                lost.append(n - len(left))
                kept.append("\n".join(left))
            yield batch_of(schema, batch.column(1), counts, lost, kept)

    return source.mapInArrow(giving_back(run), spark_schema(fields))
