"""Benchmark decontamination: windows of document words looked up in a set of benchmark windows.

DataFrame functions only. The benchmark's windows are a broadcast hash table; documents are cut into segments, and
every window of a segment is probed as it is made, its words compared in full. Only hits are shuffled, by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import written

#: Words after which a long document is cut into the next segment, so that no row holds all windows of a long text.
SEGMENT = 512
#: Benchmark windows up to which their table is broadcast; beyond, Spark shuffles both sides of the join.
BROADCAST_WINDOWS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words of the text with A-Z lower-cased: runs of digits, letters and all beyond ASCII. Null has none."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def benchmark_windows(benchmark: DataFrame, size: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(size, window, items): every window of ``size`` words of the items, and whole items of fewer, with the items holding it."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words")).where("size(words) > 0 and item is not null")
    items = items.withColumn("n", F.least(F.size("words"), F.lit(size)))
    windows = items.select("item", "n", F.explode(F.transform(F.sequence(F.lit(1), F.size("words") - F.col("n") + 1), lambda i: F.array_join(F.slice("words", i, F.col("n")), " "))).alias("window"))
    return windows.groupBy(F.col("n").alias("size"), "window").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _windows(size: int) -> Column:
    """The windows of a segment: first word (from 0, in the document), number of words, the words."""
    last = F.least(F.lit(SEGMENT), F.size("part") - size + 1)
    starts = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    part, base = F.col("part"), F.col("base")
    return F.transform(starts, lambda i: F.struct((base + i - 1).alias("start"), F.lit(size).alias("words"), F.array_join(F.slice(part, i, size), " ").alias("window")))


def find_contamination(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 13) -> DataFrame:
    """One row per input row: (doc_id, mark, n_words, n_hit, items, spans).

    ``n_hit`` is the number of words inside any occurrence of a window, ``items`` the items with occurring windows,
    sorted as strings, ``spans`` the occurrences as (first word, from 0, and number of words). ``mark`` is the hash
    of the text. Null texts and texts without a word have no hits; items without a word or an id say nothing, and
    repeated items are one. Equal rows give equal rows; null ids are fine.
    """
    windows = written(benchmark_windows(benchmark, size), "windows")
    counts = windows.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()  # ``size`` rows at most
    sizes = sorted(r["size"] for r in counts)
    worded = df.select(df[id_col].alias("doc_id"), F.xxhash64(df[text_col].cast("string")).alias("mark"), words_of(df[text_col]).alias("words"))
    words, n = F.col("words"), F.size("words")
    bases = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(SEGMENT))
    segments = F.explode(F.transform(bases, lambda b: F.struct(b.alias("base"), F.slice(words, b + 1, SEGMENT + size - 1).alias("part"))))
    cut = worded.select("doc_id", "mark", n.cast("long").alias("n_words"), segments.alias("segment")).select("doc_id", "mark", "n_words", "segment.*")
    windowed = F.concat(*[_windows(k) for k in sizes]) if sizes else F.array().cast("array<struct<start:int,words:int,window:string>>")
    first = (F.col("base") == 0) & (F.coalesce("k", F.lit(0)) == 0)
    one = cut.select("doc_id", "mark", "n_words", "base", F.posexplode_outer(windowed).alias("k", "hit"))
    one = one.select("doc_id", "mark", "n_words", first.alias("first"), "hit.start", "hit.words", "hit.window")
    table = windows.select("window", "items")
    table = F.broadcast(table) if sum(r["n"] for r in counts) <= BROADCAST_WINDOWS else table
    checked = one.join(table, "window", "left").where("first or items is not null")  # each row keeps its first window
    whole = checked.groupBy("doc_id", "mark", "n_words").agg(
        F.sum(F.col("first").cast("int")).alias("rows"),
        F.sort_array(F.collect_set(F.when(F.col("items").isNotNull(), F.struct("start", "words")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total")),
        lambda acc, x: F.struct(
            F.greatest(acc["end"], x["start"] + x["words"]).alias("end"),
            (acc["total"] + F.greatest(F.lit(0), x["start"] + x["words"] - F.greatest(acc["end"], x["start"]))).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    repeated = F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("copy")
    return whole.select("doc_id", "mark", "n_words", covered.alias("n_hit"), "items", "spans", repeated).drop("copy")


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words", parts: int = 20) -> Column:
    """At least one word in ``parts`` is hit."""
    return (F.col(n_hit) > 0) & (F.lit(parts) * F.col(n_hit) >= F.col(n_words))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 13) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    found = find_contamination(docs, benchmark, id_col, text_col, size).where(contaminated())
    bad = found.select(F.col("doc_id").alias("bad_id"), F.col("mark").alias("bad_mark")).distinct()
    same = docs[id_col].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs[text_col].cast("string")) == bad["bad_mark"])
    return docs.join(bad, same, "left_anti")
