"""Packing: documents cut into sequences of a fixed capacity by Karmarkar-Karp multiway differencing.

A task packs the documents of its own partition, a bounded number at a time, so nothing is shuffled and a lost
task is redone alone. Full sequences are cut off long documents first. Of each rest a short tail is cut off too:
with large and small parts, differencing ends in windows that are nearly equal.
"""

from __future__ import annotations

import gc
import heapq
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfcast.llm.common import arrow_schema, batch_of, byte_chunks, document_rows, giving_back, spark_schema

#: Documents in one round of differencing, and the size below which a tail is cut off a rest. Both only shape the windows.
ROUND_DOCS, TAIL = 1000, 96


def difference_windows(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each size after multiway differencing into ``windows`` windows.

    A partial partition is a list of window sums. The two with the largest imbalance (largest less smallest sum)
    are merged, the largest window of one with the smallest of the other. Missing windows count as empty. Ties go
    by age, so the result depends on the sizes alone.
    """
    parent = np.arange(2 * len(sizes) + 1, dtype=np.int64)
    used = len(sizes)
    heap = [(-int(s), i, np.array([s], dtype=np.int64), np.array([i], dtype=np.int64)) for i, s in enumerate(sizes)]
    if windows == 1:
        return np.zeros(len(sizes), dtype=np.int64)
    heapq.heapify(heap)
    age = len(sizes)
    while len(heap) > 1:
        _, _, a, an = heapq.heappop(heap)
        _, _, b, bn = heapq.heappop(heap)
        over = len(a) + len(b) - windows  # windows in which both have something
        if over <= 0:
            sums, nodes = np.concatenate([a, b]), np.concatenate([an, bn])
        else:
            keep_a, keep_b = len(a) - over, len(b) - over
            # the smallest of a, in falling order, meet the smallest of b, in rising order
            met_a, met_b = an[keep_a:], bn[keep_b:][::-1]
            new = np.arange(used, used + over, dtype=np.int64)
            if used + over > len(parent):
                parent = np.concatenate([parent, np.arange(len(parent), 2 * (used + over), dtype=np.int64)])
            parent[met_a] = new
            parent[met_b] = new
            used += over
            sums = np.concatenate([a[:keep_a], b[:keep_b], a[keep_a:] + b[keep_b:][::-1]])
            nodes = np.concatenate([an[:keep_a], bn[:keep_b], new])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        low = int(sums[-1]) if len(sums) == windows else 0
        heapq.heappush(heap, (low - int(sums[0]), age, sums, nodes))
        age += 1
    if not len(sizes):
        return np.zeros(0, dtype=np.int64)
    root = parent[: len(sizes)]
    while True:
        above = parent[root]
        if np.array_equal(above, root):
            break
        root = above
    where = np.full(len(parent), -1, dtype=np.int64)
    where[heap[0][3]] = np.arange(len(heap[0][3]))
    return where[root]


def pack(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each size, none over ``capacity``: the fewest windows that hold the sum, one more while one overflows.

    Each size must be at most ``capacity``.
    """
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        at = difference_windows(sizes, windows)
        filled = np.bincount(at, weights=sizes, minlength=windows)
        if filled.max(initial=0) <= capacity:
            return at
        windows += 1


class WordIds:
    """Token ids of texts as little-endian 32-bit bytes.

    For tokenizers that drop white space, split words by a pattern and mark word ends: no token reaches over ASCII
    white space, so a word is split by the tokenizer's own pattern once, each piece is tokenized once, and both are
    remembered: up to ``known`` new ones, and as many from before, of which those met again become new ones. So common
    words stay. Texts of other tokenizers are encoded whole.
    """

    def __init__(self, path: str, known: int = 150_000, longest: int = 64):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.longest = Tokenizer.from_file(path), known, longest
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.older: tuple[dict[bytes, bytes], dict[str, bytes]] = {}, {}
        with open(path, encoding="utf-8") as f:
            about = json.load(f)
        steps = (about.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        suffix = about["model"].get("end_of_word_suffix")
        lower = any(n.get("type") == "Lowercase" for n in (about.get("normalizer") or {}).get("normalizers", []))
        self.by_word = bool(suffix) and lower and steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed"
        if self.by_word:
            self.split = regex.compile(steps[0]["pattern"]["Regex"]).findall
            self.simple = self.split("ab,") == ["ab", ","] and self.split("\xe9\xdf") == ["\xe9\xdf"]
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
            for token, i in self.tokenizer.get_vocab().items():
                self.ends[i] = token.endswith(suffix)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _parts(self, s: str) -> list[str]:
        """The pieces of a word; words of letters, or with one sign behind them, need no pattern."""
        if self.simple:
            if s.isalpha():
                return [s]
            if s[:-1].isalpha() and not s[-1].isalnum() and not s[-1].isspace():
                return [s[:-1], s[-1]]
        return self.split(s)

    def _learn_pieces(self, pieces: list[str]) -> None:
        """Each piece ends with one end-of-word token, which tells the pieces of a long line apart."""
        lines = [pieces[i : i + 512] for i in range(0, len(pieces), 512)]
        for line, e in zip(lines, self.tokenizer.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype="<u4")
            cut = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            data = ids.tobytes()
            self.pieces.update(zip(line, [data[x:y] for x, y in zip([0, *cut], cut)], strict=True))

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return self._whole([t.decode("utf-8", "replace") for t in texts])
        # the tokenizer lowers all letters; lowering A to Z first saves words, but must not make a control string
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        if len(self.words) > self.known:
            self.older, self.words, self.pieces = (self.words, self.pieces), {}, {}
        words = self.words
        unknown = {w for line in split for w in line} - words.keys()
        words.update((w, self.older[0][w]) for w in unknown & self.older[0].keys())
        new = list(unknown - words.keys())
        plain, other = [], []
        for w in new:
            s = w.decode("utf-8", "replace")
            # marks that compose, dotted I and control strings are left to the tokenizer
            if s.isascii() and "<|" not in s or max(s) < "\u0300" and "\u0130" not in s and "<|" not in s:
                plain.append((w, self._parts(s.lower())))
            else:
                other.append((w, s))
        pieces = self.pieces
        unknown = {x for _, parts in plain for x in parts} - pieces.keys()
        pieces.update((x, self.older[1][x]) for x in unknown & self.older[1].keys())
        self._learn_pieces(list(unknown - pieces.keys()))
        for w, parts in plain:
            words[w] = pieces[parts[0]] if len(parts) == 1 else b"".join([pieces[x] for x in parts])
        words.update(zip([w for w, _ in other], self._whole([s for _, s in other]), strict=True))
        out = [b"".join([words[w] for w in line]) for line in split]
        for w in new:
            if len(w) > self.longest:
                del words[w]
        return out


def pack_documents(df: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.

    A document is its ids and then ``end_id``; null and empty texts are the end id alone. Every id lies in exactly
    one piece, a sequence has no gap and at most ``capacity`` ids. Repeated rows and null ids are packed like others.
    ``tokenizer`` is the path of a tokenizer file on every executor. Sequence ids are unique, not dense.
    """
    docs = document_rows(df, id_col, text_col)
    fields = [("doc_id", docs.schema["doc_id"].dataType)] + [(n, T.LongType()) for n in ("start", "length")]
    fields += [("ids", T.BinaryType())] + [(n, T.LongType()) for n in ("doc_tokens", "sequence_id", "offset")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # there are no cycles here, and each collection would walk millions of words
        try:
            yield from packed(batches)
        finally:
            gc.enable()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, words = arrow_schema(fields), WordIds(tokenizer)
        last = np.array([end_id], dtype="<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 36
        rest: list[tuple] = []  # (doc_id, start, ids, doc_tokens)

        def placed() -> pa.RecordBatch:
            nonlocal sequence, rest
            parts = []
            for doc, start, ids, total in rest:
                n = len(ids) // 4
                tail = n % TAIL if n > 2 * TAIL else 0
                parts += [(doc, start, ids[: 4 * (n - tail)], total)] + ([(doc, start + n - tail, ids[4 * (n - tail) :], total)] if tail else [])
            sizes = np.array([len(p[2]) // 4 for p in parts], dtype=np.int64)
            at = pack(sizes, capacity)
            order = np.argsort(at, kind="stable")  # the parts of a document in one window stay neighbours
            joined: list[list] = []
            offset, window = 0, -1
            for i in order:
                doc, start, ids, total = parts[i]
                if at[i] != window:
                    window, offset = at[i], 0
                if joined and offset and joined[-1][0] is doc and joined[-1][1] + joined[-1][2] == start:
                    joined[-1][2] += len(ids) // 4
                    joined[-1][3] += ids
                else:
                    joined.append([doc, start, len(ids) // 4, ids, total, sequence + int(window), offset])
                offset += len(ids) // 4
            sequence += int(at.max(initial=-1)) + 1
            rest = []
            return batch_of(schema, *([x.v if k == 0 else x for x in column] for k, column in enumerate(zip(*joined, strict=True))))

        for batch in batches:
            for ids, texts in byte_chunks(batch, 4 << 20):
                whole: list[list] = []
                for doc, tokens in zip(ids.to_pylist(), words([t or b"" for t in texts]), strict=True):
                    tokens += last
                    total, doc = len(tokens) // 4, _Row(doc)
                    full = total // capacity * capacity
                    for start in range(0, full, capacity):
                        whole.append([doc.v, start, capacity, tokens[4 * start : 4 * (start + capacity)], total, sequence, 0])
                        sequence += 1
                    if total > full:
                        rest.append((doc, full, tokens[4 * full :], total))
                    if len(rest) >= ROUND_DOCS:
                        yield placed()
                if whole:
                    yield batch_of(schema, *zip(*whole, strict=True))
        if rest:
            yield placed()

    return docs.mapInArrow(giving_back(run), spark_schema(fields))


class _Row:
    """One input row; rows with equal ids stay apart."""

    __slots__ = ("v",)

    def __init__(self, v):
        self.v = v
