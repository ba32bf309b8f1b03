"""SimHash near-dedup: fingerprints of word shingles, compared exactly in tiles.

Two fingerprints that differ in r bits have population counts that differ by r at most, in every part of the bits
and in sum over the parts. A tile is all distinct fingerprints with the same counts in ``PARTS`` parts; only tiles
whose counts lie within the radius are compared, by numpy exclusive-or and bit counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import arrow_schema, batch_of, byte_chunks, document_rows, giving_back, spark_schema, written
from shelfcast.llm.components import components

#: Parts of the 64 bits whose counts name a tile: at most 17 ** 4 = 83,521 tiles, whatever the input.
PARTS = 4
#: Fingerprints of a tile that one comparison holds, and visiting ones that it meets. They split work, not results.
HOME_ROWS, VISIT_ROWS = 4096, 65536


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """64 bits: a bit is 1 if it is set in over half the hashes of the ``width``-word shingles; 0 without a word."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    line, digest = b" ".join(words), xxhash.xxh64_digest
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words])[: len(words) - width + 1].tolist()
    hashed = b"".join([digest(line[a:b], 42) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())])
    n = len(starts)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 1 << 16):
        bits = np.unpackbits(np.frombuffer(hashed[8 * i : 8 * (i + (1 << 16))], dtype=np.uint8)).reshape(-1, 64)
        ones += np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fp): fp as a signed 64-bit value. One row per input row; null and empty texts have fp 0."""
    docs = document_rows(df, id_col, text_col)
    fields = [("doc_id", docs.schema["doc_id"].dataType), ("fp", T.LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(fields)
        for batch in batches:
            for ids, texts in byte_chunks(batch):
                yield batch_of(schema, ids, np.array([fingerprint(t, width) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.mapInArrow(giving_back(run), spark_schema(fields))


def _tile():
    """The counts of the parts as one number, 5 bits each."""
    step, out = 64 // PARTS, F.lit(0)
    for i in range(PARTS):
        part = F.shiftrightunsigned("fp", step * i).bitwiseAND(F.lit((1 << step) - 1).cast("long"))
        out = out + F.bit_count(part) * F.lit(1 << (5 * i))
    return out.cast("int")


def _later_neighbours(radius: int) -> list[tuple[int, ...]]:
    """Differences of counts within the radius, of each pair of opposite ones the one that is first positive."""
    near = (d for d in product(range(-radius, radius + 1), repeat=PARTS) if 0 < sum(map(abs, d)) <= radius)
    return [d for d in near if next(x for x in d if x) > 0]


def _clusters(fps: np.ndarray, radius: int) -> np.ndarray:
    """For distinct sorted fingerprints of one tile, where the smallest of each one's cluster stands."""
    low = np.arange(len(fps))
    block = max(1, (1 << 22) // max(1, len(fps)))
    pairs = []
    for i in range(0, len(fps), block):
        x, y = np.nonzero(np.bitwise_count(fps[i : i + block, None] ^ fps[None, :]) <= radius)
        pairs.append(np.column_stack([x + i, y])[x + i > y])
        if sum(map(len, pairs)) > 1 << 21:
            low = _joined(low, np.concatenate(pairs))
            pairs = []
    return _joined(low, np.concatenate(pairs)) if pairs else low


def _joined(low: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Lowers ``low`` along the pairs until nothing changes."""
    while True:
        new = low.copy()
        both = np.minimum(low[pairs[:, 0]], low[pairs[:, 1]])
        for side in (0, 1):
            np.minimum.at(new, low[pairs[:, side]], both)
        new = new[new]
        if np.array_equal(new, low):
            return low
        low = new


def _compare(home: np.ndarray, visitors: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between a tile and visitors that keep who is connected: each visitor to its first match, and each
    fingerprint of the tile to the first match of a visitor that it shares."""
    xs, ys = [], []
    block = max(1, (1 << 22) // max(1, len(home)))
    for i in range(0, len(visitors), block):
        v, h = np.nonzero(np.bitwise_count(visitors[i : i + block, None] ^ home[None, :]) <= radius)
        if not len(v):
            continue
        v = v + i
        new = np.concatenate([[True], v[1:] != v[:-1]])
        first = h[np.flatnonzero(new)[np.cumsum(new) - 1]]  # the first match of the same visitor
        xs += [visitors[v[new]], home[h[~new]]]
        ys += [home[h[new]], home[first[~new]]]
    if not xs:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    pairs = np.unique(np.column_stack([np.concatenate(xs).view(np.int64), np.concatenate(ys).view(np.int64)]), axis=0)
    return pairs[:, 0], pairs[:, 1]


def near_links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """(x, y) links between distinct fingerprints (column fp) that connect all that differ in ``radius`` bits or fewer.

    Every pair of near tiles is compared in full, but of a cluster only enough links leave a comparison to keep it
    connected: at most about one for each fingerprint taken in. ``fps`` must be distinct and is read twice.
    A tile with many fingerprints is split over several comparisons, and so are its visitors.
    """
    tiles = fps.select("fp", _tile().alias("tile"))
    steps = _later_neighbours(radius)
    at = [F.shiftright("tile", 5 * i).bitwiseAND(F.lit(31)) for i in range(PARTS)]
    top = 64 // PARTS
    reached = F.array(
        *[
            F.when(
                _all(((at[i] + F.lit(d[i])).between(0, top)) for i in range(PARTS) if d[i]),
                F.col("tile") + F.lit(sum(x << (5 * i) for i, x in enumerate(d))),
            )
            for d in steps
        ]
    )
    # how many visit a tile: summed over its neighbours' sizes, from the table of sizes alone
    sizes = tiles.groupBy("tile").agg(F.count(F.lit(1)).alias("held"))
    visits = sizes.select("held", F.explode(reached).alias("to")).where("to is not null").groupBy("to").agg(F.sum("held").alias("n"))
    plan = F.broadcast(
        sizes.join(F.broadcast(visits.withColumnRenamed("to", "tile")), "tile", "left").select(
            F.col("tile").alias("to"),
            F.ceil(F.col("held") / HOME_ROWS).cast("int").alias("homes"),
            F.greatest(F.lit(1), F.ceil(F.coalesce("n", F.lit(0)) / VISIT_ROWS)).cast("int").alias("lanes"),
        )
    )  # 83,521 rows at most
    spread = F.pmod(F.xxhash64("fp"), F.lit(1 << 30))
    own = tiles.join(plan, F.col("tile") == F.col("to")).withColumn("home", (spread % F.col("homes")).cast("int"))
    # a fingerprint is at home in one split of its tile, in every lane, and visits the other splits of its own tile
    at_home = own.select("to", "home", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("lane"), F.lit(0).alias("visits"), "fp")
    later = own.where("homes > 1").select(
        "to", F.explode(F.sequence(F.lit(0), F.col("homes") - 1)).alias("other"), "home", (F.shiftrightunsigned(spread, 8) % F.col("lanes")).cast("int").alias("lane"), "fp"
    ).where("other < home").select("to", F.col("other").alias("home"), "lane", F.lit(1).alias("visits"), "fp")
    away = (
        tiles.select("fp", F.explode(reached).alias("to"))
        .where("to is not null")
        .join(plan, "to")
        .select("to", F.explode(F.sequence(F.lit(0), F.col("homes") - 1)).alias("home"), (F.shiftrightunsigned(spread, 8) % F.col("lanes")).cast("int").alias("lane"), F.lit(1).alias("visits"), "fp")
    )
    work = at_home.unionAll(later).unionAll(away)
    dealt = work.repartition("to", "home", "lane").sortWithinPartitions("to", "home", "lane", "visits", "fp")
    fields = [("x", T.LongType()), ("y", T.LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(fields)
        key, home, done, lane_first = None, np.zeros(0, dtype=np.uint64), True, False
        for batch in batches:
            to, part, lane, visits, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            fp = fp.astype(np.int64).view(np.uint64)
            edge = np.flatnonzero((to[1:] != to[:-1]) | (part[1:] != part[:-1]) | (lane[1:] != lane[:-1])) + 1
            xs, ys = [], []
            for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(to)]):
                if key != (to[a], part[a], lane[a]):
                    if not done and lane_first:
                        _inside(home, radius, xs, ys)
                    key, home, done, lane_first = (to[a], part[a], lane[a]), fp[a:a], False, lane[a] == 0
                split = a + int(np.searchsorted(visits[a:b], 1))
                home = np.concatenate([home, fp[a:split]])
                if split < b:
                    if not done and lane_first:
                        _inside(home, radius, xs, ys)
                    done = True
                    if len(home):
                        x, y = _compare(home, fp[split:b], radius)
                        xs.append(x)
                        ys.append(y)
            if xs:
                yield batch_of(schema, np.concatenate(xs), np.concatenate(ys))
        if not done and lane_first:
            xs, ys = [], []
            _inside(home, radius, xs, ys)
            if xs:
                yield batch_of(schema, np.concatenate(xs), np.concatenate(ys))

    return dealt.mapInArrow(giving_back(run), spark_schema(fields))


def _inside(home: np.ndarray, radius: int, xs: list, ys: list) -> None:
    low = _clusters(home, radius)
    moved = np.flatnonzero(low != np.arange(len(home)))
    if len(moved):
        xs.append(home[moved].view(np.int64))
        ys.append(home[low[moved]].view(np.int64))


def _all(conditions):
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id): documents whose fingerprints differ in ``radius`` bits or fewer are linked.

    ``component_id`` is the smallest id that links reach. One row per input row. Null and empty texts share the
    fingerprint 0 and are linked like others. Repeated ids are fine; a null id is never the smallest unless alone.
    """
    docs = written(fingerprints(df, id_col, text_col, width), "fingerprints")
    known = written(docs.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    reached = components(near_links(known.select("fp"), radius), "simhash")
    grouped = known.join(reached, known["fp"] == reached["node"], "left").select(known["fp"], "first", F.coalesce("component", "fp").alias("component"))
    lowest = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    named = written(grouped.join(lowest, "component").select(F.col("fp").alias("named"), "component_id"), "classes")
    return docs.join(named, docs["fp"] == named["named"]).select("doc_id", "fp", "component_id")


def one_of_each_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``df``, with all their columns, whose id is the smallest of its component of ``simhash_components``.

    Equal texts under that id stay once. Rows with a null id cannot be named and stay.
    """
    linked = simhash_components(df, id_col, text_col, width, radius)
    smallest = linked.where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    kept = df.join(smallest, df[id_col] == smallest["kept_id"], "left_semi").dropDuplicates([id_col, text_col])
    return kept.unionAll(df.where(df[id_col].isNull()))
