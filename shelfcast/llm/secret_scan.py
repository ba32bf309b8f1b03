"""Secret scans: one combined deterministic automaton, run over all texts in one byte pass.

The rules are byte expressions. Subset construction and minimisation turn all of them into one transition array.
No rule reaches over a newline, so lines are the lanes of the pass; a line whose last state accepts is then read
again for the exact spans: backwards by a second combined automaton, whose states tell the rules that begin there,
and forward from those places.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.automaton import alt, at_least, compile_rules, compile_starts, longest, many, matching_lanes, one, opt, seq, some, word
from shelfcast.llm.common import arrow_schema, batch_of, byte_chunks, document_rows, giving_back, spark_schema

DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VALUE = one(UPPER + LOWER + DIGITS + "+/_.=-")
URL_SAFE = one(UPPER + LOWER + DIGITS + "_-")
# The key words of assignments
KEYWORDS = ["password", "passwd", "secret", "token", "api_key", "apikey"]


@dataclass(frozen=True)
class Rule:
    """``whole`` is what a match looks like; ``hit`` occurs wherever a match passes ``valid``, for the first pass."""

    kind: str
    whole: Callable
    hit: Callable
    valid: Callable[[bytes], bool] = lambda match: True


def assigned_value(match: bytes) -> bytes:
    """The value of an assignment: what follows the key word, a quote, blanks, the sign, blanks and a quote."""
    low = match.lower()
    rest = match[next(len(k) for k in KEYWORDS if low.startswith(k.encode())) :]
    if rest[:1] in (b'"', b"'"):
        rest = rest[1:]
    rest = rest.lstrip(b" ")[1:].lstrip(b" ")
    return rest[1:] if rest[:1] in (b'"', b"'") else rest


def _assign(value):
    quote, blanks = opt(one("\"'")), many(one(" "))
    return seq(alt(*[word(k, any_case=True) for k in KEYWORDS]), quote, blanks, one(":="), blanks, quote, value)


# The three base kinds, in the order in which ties are listed, then the kinds added here
BASE = [
    Rule("assign", _assign(some(VALUE)), _assign(at_least(VALUE, 6)), lambda m: len(assigned_value(m)) >= 6),
    Rule("access", seq(word("AKIA"), some(one(UPPER + DIGITS))), seq(word("AKIA"), at_least(one(UPPER + DIGITS), 16)), lambda m: len(m) >= 20),
    Rule("hex", some(one(DIGITS + "abcdef")), at_least(one(DIGITS + "abcdef"), 24), lambda m: len(m) >= 24),
]
_REPO = seq(word("gh"), one("pousr"), word("_"), at_least(one(UPPER + LOWER + DIGITS), 36))
_CHAT = seq(word("xox"), one("abprs"), word("-"), at_least(one(UPPER + LOWER + DIGITS + "-"), 10))
_WEB = seq(word("eyJ"), some(URL_SAFE), word("."), word("eyJ"), some(URL_SAFE), word("."), some(URL_SAFE))
_PEM = seq(word("-----BEGIN "), many(one(UPPER + " ")), word("PRIVATE KEY-----"))
# Their first pass looks for the telling beginning only: counters of several long rules side by side would multiply the states
ADDED = [
    Rule("repo_token", _REPO, seq(word("gh"), one("pousr"), word("_"), one(UPPER + LOWER + DIGITS))),
    Rule("chat_token", _CHAT, seq(word("xox"), one("abprs"), word("-"))),
    Rule("web_token", _WEB, word("eyJ")),
    Rule("private_key", _PEM, word("-----BEGIN ")),
]
RULES = BASE + ADDED


def _spans(line: bytes, starts, rules) -> Iterator[tuple[int, int, int]]:
    """(start, place of the rule, end) in bytes: leftmost, non-overlapping per rule, failing matches dropped.

    The line is read backwards once, which tells where matches of each rule begin; each rule reads forward from such a
    place only, to the end of its match, so no text makes it begin in vain.
    """
    auto, rows, marks = starts
    hits: list[list[int]] = [[] for _ in rules]
    state, place = auto.start, len(line)
    for c in reversed(line.translate(auto.kind)):
        place -= 1
        state = rows[state][c]
        for r in marks[state]:
            hits[r].append(place)
    for rule, (valid, single, steps, accepting) in enumerate(rules):
        codes, at = line.translate(single.kind) if hits[rule] else b"", 0
        for begin in reversed(hits[rule]):
            if begin >= at:
                at = longest(steps, accepting, codes, begin, single.start)
                if valid(line[begin:at]):
                    yield begin, rule, at


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """(doc_id, secrets array of (kind, start, end)): code points, end exclusive, by start, then in the order of the rules.

    Null and empty texts have no secrets. Every input row gives one row, also repeated ones and such with a null id.
    """
    rules = RULES if rules is None else rules
    docs = document_rows(df, id_col, text_col)
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    fields = [("doc_id", docs.schema["doc_id"].dataType), ("secrets", T.ArrayType(span))]
    combined = compile_rules([r.hit for r in rules], anywhere=True)
    single = [compile_rules([r.whole], anywhere=False) for r in rules]
    begins, marks = compile_starts([r.whole for r in rules])
    order, valid = [r.kind for r in rules], [r.valid for r in rules]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, starts = arrow_schema(fields), (begins, begins.rows(), marks)
        exact = [(v, a, a.rows(), a.accepting.tolist()) for v, a in zip(valid, single, strict=True)]
        for batch in batches:
            for ids, texts in byte_chunks(batch):
                buffer = b"\n".join(t or b"" for t in texts)
                breaks = np.flatnonzero(np.frombuffer(buffer, dtype=np.uint8) == 10)
                heads = np.concatenate([[0], breaks + 1]).astype(np.int64)
                ends = np.concatenate([breaks, [len(buffer)]]).astype(np.int64)
                owner_at = np.cumsum([0] + [len(t or b"") + 1 for t in texts])
                found: list[list] = [[] for _ in texts]
                for i in np.flatnonzero(matching_lanes(combined, buffer, heads, ends - heads)):
                    a, e = int(heads[i]), int(ends[i])
                    owner = int(np.searchsorted(owner_at, a, side="right")) - 1
                    line = buffer[a:e]
                    before = len(buffer[owner_at[owner] : a].decode("utf-8", "replace"))
                    for x, place, y in sorted(_spans(line, starts, exact)):
                        p = before + len(line[:x].decode("utf-8", "replace"))
                        found[owner].append({"kind": order[place], "start": p, "end": p + len(line[x:y].decode("utf-8", "replace"))})
                yield batch_of(schema, ids, found)

    return docs.mapInArrow(giving_back(scan), spark_schema(fields))


def span_list(secrets, kinds: list[str] | None = None):
    """The spans as text, kind:start:end joined by commas; only of ``kinds`` if given."""
    kept = F.filter(secrets, lambda s: s["kind"].isin(kinds)) if kinds else secrets
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
