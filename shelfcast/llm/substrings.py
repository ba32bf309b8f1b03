"""Substring dedup: seed and extend on winnowed anchors, removing what long repeats cover.

An anchor is a run of ``ANCHOR`` words whose hash is the smallest in a window of ``length`` words, so equal windows
have equal anchors. The windows of one anchor form a block: the anchor extended both ways as far as it stays the
smallest. A block whose words occur earlier is a repeat as a whole, whatever the number of copies. Only where
blocks that differ share an anchor are the windows inside compared, so that the extension ends at the exact word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import arrow_schema, batch_of, byte_chunks, document_rows, giving_back, spark_schema, written

#: Words of an anchor; fewer if the repeats asked for are shorter.
ANCHOR = 6
#: Odd factors of the two rolling hashes, and their inverses modulo 2 ** 64.
FACTORS = (0x9E3779B97F4A7C17, 0xD6E8FEB86659FD97)
INVERSES = tuple(pow(f, -1, 1 << 64) for f in FACTORS)


def _powers(factor: int, n: int) -> np.ndarray:
    """The powers 0 to ``n`` modulo 2 ** 64."""
    out = np.full(n + 1, factor, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Words:
    """The words of several texts in a row, as hashes whose runs can be hashed in constant time."""

    def __init__(self, texts: list[bytes]):
        import xxhash

        split = [t.split() for t in texts]
        self.counts = np.array([len(s) for s in split], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        digest = xxhash.xxh3_64_digest
        self.hashes = np.frombuffer(b"".join([digest(w) for s in split for w in s]), dtype=">u8").astype(np.uint64)
        self.powers, self.sums = [], []
        n = len(self.hashes)
        for k, (factor, inverse) in enumerate(zip(FACTORS, INVERSES, strict=True)):
            values = self.hashes if not k else (self.hashes ^ (self.hashes >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            self.powers.append(_powers(inverse, n))
            self.sums.append(np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values * _powers(factor, n)[:n])]))

    def runs(self, k: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes, by the ``k``-th factor, of the words from each start to each end."""
        mixed = (self.sums[k][end] - self.sums[k][start]) * self.powers[k][start]
        return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)

    def pair(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.runs(0, start, end).view(np.int64), self.runs(1, start, end).view(np.int64)


def blocks_of(words: Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor hash, text) of every block; windows are named by their first word."""
    none = np.zeros(0, dtype=np.int64)
    width = min(ANCHOR, length)
    many, n = length - width + 1, len(words.hashes)
    text = np.repeat(np.arange(len(words.counts)), words.counts)
    at = np.arange(max(0, n - length + 1))
    at = at[at + length <= words.starts[text[: len(at)] + 1]]
    if not len(at):
        return none, none, none, none
    grams = words.runs(0, np.arange(n - width + 1), np.arange(width, n + 1))
    view = np.lib.stride_tricks.sliding_window_view(grams, many)
    low = np.empty(len(at), dtype=np.int64)
    for i in range(0, len(at), 1 << 17):  # of equal hashes the last counts
        part = at[i : i + (1 << 17)]
        low[i : i + (1 << 17)] = part + many - 1 - view[part][:, ::-1].argmin(axis=1)
    owner = text[at]
    new = np.concatenate([[True], (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(at)]]) - 1
    return at[first], at[last], grams[low[first]].view(np.int64), owner[first]


def _marks(texts: list[bytes]) -> np.ndarray:
    return np.array([zlib.crc32(t) << 32 for t in texts], dtype=np.uint64)


def anchored_blocks(docs: DataFrame, length: int) -> DataFrame:
    """(b1, b2, anchor, doc_id, place, windows): every block with the 128-bit hash of its words.

    ``place`` is the block's first word in the text, below the crc32 of the text.
    """
    fields = [(n, T.LongType()) for n in ("b1", "b2", "anchor", "doc_id", "place")] + [("windows", T.IntegerType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(fields)
        for batch in batches:
            for ids, texts in byte_chunks(batch):
                texts = [t or b"" for t in texts]
                words = Words(texts)
                first, last, anchor, text = blocks_of(words, length)
                b1, b2 = words.pair(first, last + length)
                place = (_marks(texts)[text] | (first - words.starts[text]).astype(np.uint64)).view(np.int64)
                yield batch_of(schema, b1, b2, anchor, ids.take(pa.array(text)), place, last - first + 1)

    return docs.mapInArrow(giving_back(run), spark_schema(fields))


def _by_text(spans: DataFrame) -> DataFrame:
    """(doc_id, mark, spans array of (start, windows)): bounded by the text's own length, also where rows repeat."""
    start = F.col("place").bitwiseAND(F.lit((1 << 32) - 1)).cast("long")
    return (
        spans.select("doc_id", F.shiftrightunsigned("place", 32).alias("mark"), F.struct(start.alias("start"), "windows").alias("span"))
        .groupBy(F.col("doc_id").alias("of"), "mark")
        .agg(F.collect_set("span").alias("spans"))
    )


def _starts(spans) -> np.ndarray:
    """The first words of all windows of the spans."""
    start, windows = (spans.values.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
    return np.repeat(start - np.concatenate([[0], np.cumsum(windows)[:-1]]), windows) + np.arange(windows.sum())


def _windows_inside(docs: DataFrame, blocks: DataFrame, length: int) -> DataFrame:
    """(b1, b2, doc_id, place) of every window in the given blocks."""
    asked = _by_text(blocks)
    source = docs.join(asked, (docs["doc_id"] == asked["of"]) & (F.crc32(docs["text"].cast("binary")) == asked["mark"])).select("doc_id", "text", "spans")
    fields = [(n, T.LongType()) for n in ("b1", "b2", "doc_id", "place")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(fields)
        for batch in batches:
            at = 0
            for ids, texts in byte_chunks(batch):
                words, marks = Words(texts), _marks(texts)
                inside = [_starts(batch.column(2)[at + i]) for i in range(len(texts))]
                text = np.repeat(np.arange(len(texts)), [len(x) for x in inside])
                inside = np.concatenate(inside)
                begin = words.starts[text] + inside
                b1, b2 = words.pair(begin, begin + length)
                yield batch_of(schema, b1, b2, ids.take(pa.array(text)), (marks[text] | inside.astype(np.uint64)).view(np.int64))
                at += len(texts)

    return source.mapInArrow(giving_back(run), spark_schema(fields))


def _later(rows: DataFrame) -> DataFrame:
    """The rows whose hash also stands at an earlier place. The earliest is an aggregate, reduced before the shuffle."""
    earliest = rows.groupBy("b1", "b2").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.max(F.struct("doc_id", "place")).alias("last"))
    # written, so that the join meets two plain tables and Spark can split the copies of one passage over tasks
    often = written(earliest.where("first <> last").select("b1", "b2", "first"), "often")
    return rows.join(often, ["b1", "b2"]).where(F.struct("doc_id", "place") > F.col("first"))


def repeated_spans(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, place, windows): runs of windows of (doc_id, text) whose words also start earlier.

    Earlier: at a smaller id, or in the same text at an earlier word.
    """
    blocks = written(anchored_blocks(docs, length), "blocks")
    copied = written(_later(blocks).select("doc_id", "place", "windows"), "copied")
    # an anchor with blocks that differ: the windows that they share are found by their own hashes
    shared = blocks.groupBy("anchor").agg(F.min("b1").alias("least"), F.max("b1").alias("most")).where("least <> most")
    differing = blocks.join(written(shared.select("anchor"), "shared"), "anchor", "left_semi")
    firsts = differing.groupBy("b1", "b2").agg(F.min(F.struct("doc_id", "place", "windows")).alias("first")).select("first.*")
    windows = written(_windows_inside(docs, written(firsts, "differing"), length), "windows")
    return copied.unionAll(_later(windows).select("doc_id", "place", F.lit(1).alias("windows")))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 20) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept (the words left, joined by a space).

    A word goes if a window of ``length`` words over it has words that also start earlier in the input. Null and
    empty texts have no words. Rows with a null id keep all words and do not count; ids must be whole numbers. Equal
    rows are one text; rows that share an id but not the text are ordered by the text's crc32.
    """
    docs = document_rows(df, id_col, text_col)
    known = docs.where("doc_id is not null and text is not null").withColumn("doc_id", F.col("doc_id").cast("long"))
    spans = _by_text(written(repeated_spans(known, length), "repeats"))
    mark = F.crc32(docs["text"].cast("binary"))
    source = docs.join(spans, (docs["doc_id"] == spans["of"]) & (mark == spans["mark"]), "left").select("doc_id", "text", "spans")
    fields = [("doc_id", docs.schema["doc_id"].dataType), ("n_words", T.LongType()), ("n_removed", T.LongType()), ("kept", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(fields)
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                words = (text.as_py() or "").encode().split()
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                if spans.is_valid:
                    start, windows = (spans.values.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
                    np.add.at(gone, start, 1)
                    np.add.at(gone, start + windows - 1 + length, -1)
                    left = [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g]
                else:
                    left = words
                counts.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode("utf-8", "replace"))
            yield batch_of(schema, batch.column(0), counts, removed, kept)

    return source.mapInArrow(giving_back(run), spark_schema(fields))
