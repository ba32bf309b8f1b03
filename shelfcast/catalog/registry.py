"""Registration of named queries and of the SQL they are compared with."""

from __future__ import annotations

import re

from shelfcast.catalog.reference_sql import TABLES

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; ``sql`` may use the domain tables by name."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = expand(sql)
        return fn

    return add


def _needed(text: str, seen: list) -> list:
    for word in dict.fromkeys(re.findall(r"[a-z_][a-z_0-9]*", text)):
        if word in TABLES and word not in seen:
            _needed(TABLES[word], seen)
            if word not in seen:
                seen.append(word)
    return seen


def expand(sql: str) -> str:
    """Put the definitions of the domain tables a statement uses in front of it."""
    body = sql.strip()
    local = set(re.findall(r"([a-z_][a-z_0-9]*) AS \(", body))
    names = [n for n in _needed(body, []) if n not in local]
    defs = ",\n".join(f"{n} AS ({TABLES[n].strip()})" for n in names)
    if not defs:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {defs},\n{body[5:]}"
    return f"WITH {defs}\n{body}"
