"""Toxicity: votes of the nearest labelled examples, by exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import heapq
import io
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import arrow_schema, batch_of, byte_chunks, document_rows, giving_back, ids_and_texts, spark_schema, whole_rows, written
from shelfcast.llm.quality import fit_platt
from shelfcast.llm.sampling import in_one_task, sampled_ids

#: Labelled rows of each label that the fit reads at most, neighbours that vote, examples of a block.
SAMPLE_ROWS, NEIGHBOURS, BLOCK = 2500, 12, 32
#: Weight of a term that tells nothing of the labels, and squared distance at which a vote counts half of a copy's.
FLOOR, NEAR = 0.02, 0.02
#: Lengths of the stems that are terms beside the words; words remembered by a task, and all their letters.
STEMS, KNOWN_WORDS, KNOWN_LETTERS = (5,), 150_000, 4_000_000
#: A term in more than one in so many examples is a row of the index's matrix. Splits work, not results.
COMMON = 40
#: Texts whose common terms are multiplied at once.
AT_ONCE = 64
WORDS = regex.compile(r"\p{L}+").findall
ASCII_WORDS = re.compile("[a-z]+").findall


def word_terms(word: str) -> list[str]:
    """A word and its first letters as stems, so that a new ending of a known stem still has known terms."""
    return [word, *(f"{word[:n]}-" for n in STEMS if len(word) >= n)]


def word_counts(text: str) -> Counter:
    low = text.lower()
    return Counter(ASCII_WORDS(low) if low.isascii() else WORDS(low))


def term_counts(text: str) -> Counter:
    out: Counter = Counter()
    for word, n in word_counts(text).items():
        for term in set(word_terms(word)):
            out[term] += n
    return out


def sketch(text: str) -> tuple[int, ...]:
    """The two smallest hashes of the 3-word shingles: equal for copies and for most near copies."""
    words = WORDS(text.lower())
    shingles = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
    return tuple(heapq.nsmallest(2, (zlib.crc32(s.encode()) for s in shingles)))


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All whole numbers from each ``start`` to below its ``end``, one after the other."""
    size = end - start
    return np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())


def _arrays(vector: dict[int, float]) -> tuple[np.ndarray, np.ndarray]:
    return np.fromiter(vector.keys(), np.int64, len(vector)), np.fromiter(vector.values(), np.float64, len(vector))


class Index:
    """Postings of the examples by term and block of ``BLOCK`` examples, with the largest weight of each term and block.

    Runs are the postings of one term in one block: ``ptr`` holds the first run of each term, ``first`` the first posting
    of each run. Terms in more than one example in ``COMMON`` are rows of a matrix instead, added up for all examples in one
    product. ``nearest`` is exact: postings of a block are left out only if no example in it can reach the worst neighbour so far.
    """

    def __init__(self, ptr: np.ndarray, first: np.ndarray, example: np.ndarray, weight: np.ndarray):
        self.ptr, self.first, self.example, self.weight = ptr, first, example, weight
        self.block = example[first[:-1]] // BLOCK
        self.peak = np.maximum.reduceat(weight, first[:-1]) if len(weight) else weight
        self.blocks = int(example.max(initial=-1)) // BLOCK + 1 if len(example) else 0
        width = self.blocks * BLOCK
        begin, until = first[ptr[:-1]], first[ptr[1:]]
        common = np.flatnonzero(until - begin > width // COMMON)
        self.column = np.full(len(begin), -1, dtype=np.int32)
        self.column[common] = np.arange(len(common))
        self.matrix = np.zeros((len(common), width), dtype=np.float32)
        for c, t in enumerate(common.tolist()):
            self.matrix[c, example[begin[t] : until[t]]] = weight[begin[t] : until[t]]

    @classmethod
    def build(cls, vectors: list, terms: int) -> Index:
        """An index of vectors, given as {term: weight} or as (terms, weights)."""
        pairs = [_arrays(v) if isinstance(v, dict) else v for v in vectors]
        size = [len(t) for t, _ in pairs]
        term = np.concatenate([t for t, _ in pairs] or [np.zeros(0, dtype=np.int64)])
        example = np.repeat(np.arange(len(pairs), dtype=np.int32), size)
        weight = np.concatenate([w for _, w in pairs] or [np.zeros(0)]).astype(np.float32)
        order = np.lexsort((example, term))
        return cls.of(term[order], example[order], weight[order], terms)

    @classmethod
    def of(cls, term: np.ndarray, example: np.ndarray, weight: np.ndarray, terms: int) -> Index:
        """An index of postings that are sorted by term and example."""
        new = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(example // BLOCK, prepend=-1) != 0))
        return cls(np.searchsorted(term[new], np.arange(terms + 1)).astype(np.int32), np.append(new, len(term)).astype(np.int32), example, weight)

    def nearest(self, vector: dict | tuple, k: int, leave_out: int = -1) -> list[tuple[int, float]]:
        """The ``k`` examples of the largest positive cosine, ties by number."""
        return self.nearest_all([vector], k, [leave_out])[0]

    def nearest_all(self, vectors: list, k: int, leave_out: list[int] | None = None) -> list[list[tuple[int, float]]]:
        """``nearest`` of each vector, given as {term: weight} or as (terms, weights)."""
        pairs = [_arrays(v) if isinstance(v, dict) else v for v in vectors]
        text = np.repeat(np.arange(len(pairs)), [len(t) for t, _ in pairs])
        return self.nearest_of(text, np.concatenate([t for t, _ in pairs]), np.concatenate([w for _, w in pairs]), len(pairs), k, leave_out)

    def nearest_of(self, text: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, k: int, leave_out: list[int] | None = None) -> list[list[tuple[int, float]]]:
        """``nearest`` of ``n`` vectors together, whose entries are (text, term, weight).

        The common terms of all are one product. All weights are positive, so the k-th best of these sums is a floor of the
        k-th best score, and the rare terms are read only in blocks whose bound passes it.
        """
        width = self.blocks * BLOCK
        if not width or not n:
            return [[] for _ in range(n)]
        often = self.column[terms] >= 0
        dense = np.zeros((n, len(self.matrix)), dtype=np.float32)
        dense[text[often], self.column[terms[often]]] = weights[often]
        scores = (dense @ self.matrix).astype(np.float64)
        if leave_out is not None:
            here = np.flatnonzero(np.array(leave_out) >= 0)
            scores[here, np.array(leave_out)[here]] = -9.0
        text, terms, weights = text[~often], terms[~often], weights[~often]
        start, end = self.ptr[terms], self.ptr[terms + 1]
        runs, text, weights = _ranges(start, end), np.repeat(text, end - start), np.repeat(weights, end - start)
        cell = text * self.blocks + self.block[runs]
        bound = np.bincount(cell, weights=weights * self.peak[runs], minlength=n * self.blocks) + scores.reshape(-1, BLOCK).max(axis=1)
        open_ = bound > np.repeat(self._floor(scores, k), self.blocks)
        now = np.flatnonzero(open_[cell])
        begin, until = self.first[runs[now]], self.first[runs[now] + 1]
        posts = _ranges(begin, until)
        at = np.repeat(text[now] * width, until - begin) + self.example[posts]
        scores += np.bincount(at, weights=self.weight[posts] * np.repeat(weights[now], until - begin), minlength=n * width).reshape(n, width)
        row, found = np.nonzero(scores > self._floor(scores, k)[:, None])
        value = scores[row, found]
        order = np.lexsort((found, -np.round(value, 6), row))
        found, value = found[order].tolist(), np.minimum(value[order], 1.0).tolist()
        ends = np.searchsorted(row, np.arange(n + 1)).tolist()
        return [list(zip(found[i:j][:k], value[i:j][:k], strict=True)) for i, j in zip(ends, ends[1:])]

    @staticmethod
    def _floor(scores: np.ndarray, k: int) -> np.ndarray:
        """Below the k-th best of each row of scores, rounding apart, and at least 0."""
        worst = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] >= k else np.zeros(len(scores))
        return np.maximum(0.0, worst - 1e-5)


def _numbered(counts: Counter, number: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    return _arrays({number[t]: n for t, n in counts.items() if t in number})


def _unit(terms: np.ndarray, counts: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers with their weights, as a vector of length 1."""
    raw = (1 + np.log(counts)) * scale[terms]
    return terms, raw / max(float(np.sqrt(raw @ raw)), 1e-300)


def _vote(near: list[tuple[int, float]], labels: np.ndarray) -> float:
    """Share of toxic neighbours, weighted by nearness, beside one vote for not toxic.

    A copy has about fifty votes, a neighbour far away next to none, so clean neighbours and distance both count against.
    """
    weight = [s * s / (1 - s * s + NEAR) for _, s in near]
    return sum(w * float(labels[i]) for w, (i, _) in zip(weight, near, strict=True)) / (sum(weight) + 1)


def _told(a: np.ndarray, b: np.ndarray, n: list[int]) -> np.ndarray:
    """Log-likelihood ratio of terms in ``a`` of n[1] toxic and ``b`` of n[0] other examples: what a term tells of the label."""
    share = (a + b) / sum(n)

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-300)), 0.0)

    both = part(a, n[1] * share) + part(b, n[0] * share) + part(n[1] - a, n[1] * (1 - share)) + part(n[0] - b, n[0] * (1 - share))
    return np.maximum(both, 0.0)


def _fit(table: pa.Table, share: float) -> bytes:
    ids, labels = table["sample_id"].to_pylist(), table["label"].to_numpy().astype(np.int64)
    texts = [t or "" for t in table["text"].to_pylist()]
    seen = [set() for _ in (0, 1)]
    sides = [Counter(), Counter()]
    for text, y in zip(texts, labels.tolist(), strict=True):
        mark = sketch(text)
        if mark not in seen[y]:  # copies, and most near copies, count once
            seen[y].add(mark)
            sides[y].update(term_counts(text).keys())
    n = [max(1, len(marks)) for marks in seen]  # shares are of the same examples as the counts
    vocabulary = sorted(sides[0].keys() | sides[1].keys())
    a, b = (np.array([side[t] for t in vocabulary], dtype=np.float64) for side in (sides[1], sides[0]))
    told = np.sqrt(_told(a, b, n))
    scale = np.log(1 + sum(n) / np.maximum(a + b, 1)) * (FLOOR + told / max(float(told.max(initial=0.0)), 1e-300))
    number = {t: i for i, t in enumerate(vocabulary)}
    counted = [_numbered(term_counts(t), number) for t in texts]  # counted again: all words at once would fill the worker
    vectors = [_unit(t, c, scale) for t, c in counted]
    order = sorted(range(len(vectors)), key=lambda i: (vectors[i][0][np.argsort(-vectors[i][1], kind="stable")[:3]].tolist(), i))  # alike ones share blocks
    index, own = Index.build([vectors[i] for i in order], len(vocabulary)), labels[order]
    place = {i: p for p, i in enumerate(order)}
    near = [x for i in range(0, len(vectors), AT_ONCE) for x in index.nearest_all(vectors[i : i + AT_ONCE], NEIGHBOURS, [place[j] for j in range(i, min(i + AT_ONCE, len(vectors)))])]
    votes = np.array([_vote(x, own) for x in near])
    slope, level = fit_platt(votes * 8 - 4, labels.astype(float))
    toxic = int(labels.sum())
    level += math.log(share / (1 - share)) - math.log(toxic / (len(labels) - toxic))
    term, many = (np.concatenate([counted[i][side] for i in order]) for side in (0, 1))
    example = np.repeat(np.arange(len(order), dtype=np.int32), [len(counted[i][0]) for i in order])
    sort = np.lexsort((example, term))
    out = io.BytesIO()
    np.savez_compressed(  # postings as counts: a tenth of the index they give
        out,
        vocabulary=np.frombuffer("\n".join(vocabulary).encode(), dtype=np.uint8),
        terms=scale,
        sizes=np.bincount(term, minlength=len(vocabulary)).astype(np.int32),
        example=example[sort].astype(np.min_scalar_type(len(order))),
        many=many[sort].astype(np.min_scalar_type(int(many.max(initial=0)))),
        labels=own,
        ids=np.frombuffer("\n".join(str(ids[i]).encode().hex() for i in order).encode(), dtype=np.uint8),
        scale=np.array([slope, level]),
    )
    return out.getvalue()


class Model:
    """What ``_fit`` has learnt, with the index built again."""

    def __init__(self, model: bytes):
        m = np.load(io.BytesIO(model))
        words = m["vocabulary"].tobytes().decode().split("\n")
        self.number = {t: i for i, t in enumerate(words)}
        self.scale, self.labels, (self.slope, self.level) = m["terms"], m["labels"], m["scale"].tolist()
        self.ids = [bytes.fromhex(x).decode() for x in m["ids"].tobytes().decode().split("\n")]
        term, example = np.repeat(np.arange(len(words)), m["sizes"]), m["example"].astype(np.int32)
        raw = (1 + np.log(m["many"].astype(np.float64))) * self.scale[term]
        length = np.sqrt(np.bincount(example, weights=raw * raw, minlength=len(self.labels)))
        self.index = Index.of(term, example, (raw / np.maximum(length, 1e-300)[example]).astype(np.float32), len(words))

    def score(self, near: list[tuple[int, float]]) -> float:
        """The calibrated probability of label 1 after the neighbours' votes."""
        return float(1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * (_vote(near, self.labels) * 8 - 4) + self.level)))))


class Words:
    """The term numbers of words, each looked up once while it is remembered."""

    def __init__(self, number: dict[str, int]):
        self.number = number
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.letters = 0
        self.terms = np.full((1 << 12, 1 + len(STEMS)), -1, dtype=np.int64)

    def _new(self, word: str) -> int:
        at = self.known[word] = len(self.known)
        self.letters += len(word)
        if at == len(self.terms):
            self.terms = np.concatenate([self.terms, np.full_like(self.terms, -1)])
        for i, term in enumerate(word_terms(word)):
            self.terms[at, i] = self.number.get(term, -1)
        return at

    def term_counts(self, counted: list[Counter]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, count) of all texts' words, sorted, each text and term once."""
        if len(self.known) > KNOWN_WORDS or self.letters > KNOWN_LETTERS:
            self.clear()
        known, new = self.known.get, self._new
        at = [new(w) if (i := known(w)) is None else i for words in counted for w in words]
        size = np.array([len(words) for words in counted])
        counts = np.fromiter((n for words in counted for n in words.values()), np.float64, len(at))
        terms = self.terms[np.array(at, dtype=np.int64)]
        text = np.repeat(np.arange(len(counted)), size)[:, None] * len(self.number) + terms
        there = terms >= 0
        key, place = np.unique(text[there], return_inverse=True)
        many = np.bincount(place.reshape(-1), weights=np.broadcast_to(counts[:, None], terms.shape)[there], minlength=len(key))
        return *np.divmod(key, max(1, len(self.number))), many


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> bytes:
    """The index as bytes, from up to ``sample_rows`` distinct texts of each label of ``labels`` (id, label: 1 toxic, 0 not).

    Empty if a label is missing. Votes of each example's neighbours without itself give the calibration, and the
    share of toxic texts among all distinct labelled ones corrects for the balanced sample.
    """
    labels = labels.select("id", F.col("label").cast("int").alias("label")).where("label in (0, 1)")
    marked = docs.select("doc_id", F.xxhash64("text").alias("mark"))  # texts are not moved for the join
    known = labels.join(marked, labels["id"] == marked["doc_id"]).groupBy("label", "mark").agg(F.min("id").alias("id"))
    distinct = written(known.select("id", "label"), "examples")  # copies would fill the sample
    counts = {r["label"]: r["n"] for r in distinct.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if counts.keys() != {0, 1}:
        return b""
    ids = sampled_ids(distinct, sample_rows)
    sample = docs.join(F.broadcast(ids), docs["doc_id"] == ids["sample_id"]).select("sample_id", "label", "text")  # bounded by the sample
    share = counts[1] / (counts[0] + counts[1])
    return in_one_task(sample, lambda table: _fit(table, share) if len(set(table["label"].to_pylist())) == 2 else b"")


def score_toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per input row: doc_id, score (probability of label 1), evidence (the three nearest examples), row.

    ``row`` is the whole input row as a struct, so that a filter on the score needs no join.

    Every sampled example votes with its whole vector. Texts without a term of any
    example, null and empty ones too, have no neighbours and get the score of an empty vote; where nothing could be learnt every score is 0. Repeated rows score alike.
    """
    docs = document_rows(df, id_col, text_col)
    model = fit_toxicity(docs, labels, sample_rows)
    piece = T.StructType([T.StructField("example", T.StringType()), T.StructField("cosine", T.DoubleType()), T.StructField("label", T.IntegerType())])
    whole = whole_rows(df, id_col)
    fields = [("doc_id", docs.schema["doc_id"].dataType), ("score", T.DoubleType()), ("evidence", T.ArrayType(piece)), ("row", whole.schema["row"].dataType)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(fields)
        if not model:
            for batch in batches:
                yield batch_of(schema, batch.column(0), [0.0] * batch.num_rows, [[]] * batch.num_rows, batch.column(1))
            return
        m = Model(model)
        words = Words(m.number)

        for batch in batches:
            at = 0
            for part, texts in byte_chunks(ids_and_texts(batch, text_col)):
                scores, evidence = [], []
                for i in range(0, len(texts), AT_ONCE):
                    counted = [word_counts((t or b"").decode("utf-8", "replace")) for t in texts[i : i + AT_ONCE]]
                    text, terms, counts = words.term_counts(counted)
                    raw = (1 + np.log(counts)) * m.scale[terms]
                    length = np.sqrt(np.bincount(text, weights=raw * raw, minlength=len(counted)))
                    for near in m.index.nearest_of(text, terms, raw / np.maximum(length, 1e-300)[text], len(counted), NEIGHBOURS):
                        scores.append(m.score(near))
                        evidence.append([{"example": m.ids[i], "cosine": s, "label": int(m.labels[i])} for i, s in near[:3]])
                yield batch_of(schema, part, scores, evidence, batch.column(1).slice(at, len(part)))
                at += len(part)

    return whole.mapInArrow(giving_back(run), spark_schema(fields))
