"""Whitening: exact cross-products from bit planes, centred as integers, then principal components of unit variance.

Each dimension is shifted to start at zero and cut into bit planes; a plane of many rows is packed into 64-bit words.
The cross-product of two dimensions is the sum over their planes of popcount(a AND b) times the planes' weights. A
dimension of ones beside them gives the sums and the count. Nothing is rounded before the eigenvectors.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import arrow_schema, batch_of, giving_back, spark_schema
from shelfcast.llm.vectors import dimension, in_one_place, integer_vectors, unpacked

#: Rows whose planes are packed together; a plane is this many bits.
PLANE_ROWS = 8192
#: Sums of products travel as four 32-bit limbs, each summed as a 64-bit number by Spark.
LIMBS, LIMB_BITS = 4, 32
DEVIATION = T.DecimalType(38, 0)


def bit_planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The packed planes of non-negative columns, and the column and the bit of each plane; planes of a column are adjacent."""
    rows, d = shifted.shape
    bits = [int(top).bit_length() for top in shifted.max(axis=0)]
    column = np.repeat(np.arange(d), bits)
    bit = np.concatenate([np.arange(b) for b in bits] + [np.zeros(0, dtype=np.int64)]).astype(np.int64)
    planes = np.zeros((len(column), -(-rows // 64) * 8), dtype=np.uint8)
    for p, (j, b) in enumerate(zip(column, bit, strict=True)):
        set_bits = np.packbits((shifted[:, j] >> np.uint64(b)).astype(np.uint8) & 1)
        planes[p, : len(set_bits)] = set_bits
    return planes.view(np.uint64), column, bit


def cross_products(rows: np.ndarray) -> np.ndarray:
    """The exact sums of products of each two columns of 64-bit integers, as Python integers; upper triangle only."""
    d = rows.shape[1]
    low = rows.min(axis=0)
    shifted = rows.astype(np.uint64) - low.astype(np.uint64)  # modulo 2**64, so right over the whole range
    planes, column, bit = bit_planes(shifted)
    widest = int(bit.max()) + 1 if len(bit) else 0
    kind = np.int64 if 2 * widest + len(rows).bit_length() < 62 else object
    weight = np.array([1 << int(b) for b in bit], dtype=kind)
    out = np.zeros((d, d), dtype=kind)
    first = np.searchsorted(column, np.arange(d))
    for p in range(len(planes)):
        start = int(first[column[p]])  # from the first plane of its own column on
        common = np.bitwise_count(planes[start:] & planes[p]).sum(axis=1, dtype=np.int64).astype(kind) * weight[start:]
        others, places = np.unique(column[start:], return_index=True)
        out[column[p], others] += np.add.reduceat(common, places) * weight[p]
    least = np.array([int(v) for v in low], dtype=object)
    sums = np.array([sum(int(v) for v in shifted[:, j]) if kind is object else int(shifted[:, j].sum()) for j in range(d)], dtype=object)
    products = out.astype(object) + np.outer(least, sums) + np.outer(sums, least) + len(rows) * np.outer(least, least)
    return np.triu(products)


def limbs(value: int) -> list[int]:
    """A signed integer of up to 159 bits as limbs, the topmost one signed."""
    low = [value >> (LIMB_BITS * i) & ((1 << LIMB_BITS) - 1) for i in range(LIMBS - 1)]
    return [*low, value >> (LIMB_BITS * (LIMBS - 1))]


def scatter(vectors: DataFrame, d: int) -> DataFrame:
    """(j, k, l0 .. l3): the sums of products of dimensions j <= k of the packed vectors ``x``; dimension d is all ones."""
    names = [f"l{i}" for i in range(LIMBS)]
    fields = [("j", T.IntegerType()), ("k", T.IntegerType()), *[(n, T.LongType()) for n in names]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, total = arrow_schema(fields), None
        for batch in batches:
            for at in range(0, batch.num_rows, PLANE_ROWS):
                x = unpacked(batch.column(0).slice(at, PLANE_ROWS), d)
                part = cross_products(np.concatenate([x, np.ones((len(x), 1), dtype=np.int64)], axis=1))
                total = part if total is None else total + part
        if total is not None:
            j, k = np.triu_indices(d + 1)
            for at in range(0, len(j), 1 << 16):
                some = slice(at, at + (1 << 16))
                cut = np.array([limbs(int(v)) for v in total[j[some], k[some]]], dtype=np.int64)
                yield batch_of(schema, j[some].astype(np.int32), k[some].astype(np.int32), *[cut[:, i] for i in range(LIMBS)])

    parts = vectors.select("x").mapInArrow(giving_back(run), spark_schema(fields))
    return parts.groupBy("j", "k").agg(*[F.sum(n).alias(n) for n in names])


def principal(sums: pa.Table, d: int, components: int) -> bytes:
    """The whitening as JSON: count, sums, components, their standard deviations, explained shares, identity error."""
    cross = np.zeros((d + 1, d + 1), dtype=object)
    parts = [sums[f"l{i}"].to_pylist() for i in range(LIMBS)]
    for j, k, *cut in zip(sums["j"].to_pylist(), sums["k"].to_pylist(), *parts, strict=True):
        cross[j, k] = cross[k, j] = sum(v << (LIMB_BITS * i) for i, v in enumerate(cut))
    n, total = cross[d, d], cross[:d, d]
    centred = n * cross[:d, :d] - np.outer(total, total)  # n * n times the covariance, exact
    covariance = np.array([[v / (n * n) for v in row] for row in centred], dtype=np.float64)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[: min(components, d)]
    values, vectors = values[order], vectors[:, order]
    trace = sum(centred[i, i] for i in range(d)) / (n * n)
    values = np.where(values > d * np.finfo(float).eps * trace, values, 0.0)
    spread = np.sqrt(values)
    live = np.flatnonzero(spread)
    scaled = vectors[:, live] / spread[live]
    error = np.abs(scaled.T @ covariance @ scaled - np.eye(len(live))).max() if len(live) else 0.0
    model = {
        "n": n,
        "sums": total.tolist(),
        "vectors": vectors.tolist(),
        "spread": spread.tolist(),
        "explained": (values / trace if trace else values).tolist(),
        "identity_error": float(error),
    }
    return json.dumps(model).encode()


def fit_whitening(vectors: DataFrame, d: int, components: int) -> bytes:
    """The whitening of the distinct ``x`` of ``integer_vectors``; b"" if there is none."""
    return in_one_place(scatter(vectors.select("x").distinct(), d), lambda sums: principal(sums, d, components))


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256, components: int | None = 4) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Every distinct vector counts once in the fit; every row is whitened, repeated rows alike. ``components`` None is
    all. Left out are rows whose vector is null, has a null or non-finite entry or another length than most vectors
    have; null ids stay. A component without variance has whitened and explained 0 and no part in identity_error.
    ``deviation`` is a decimal, null beyond 38 digits. An empty table gives no rows.
    """
    d = dimension(df, vec_col)
    rows = integer_vectors(df, id_col, vec_col, max(d, 1), scale)
    few = d if components is None else min(components, d)
    model = fit_whitening(rows, d, few) if d else b""
    fields = [
        ("vec_id", rows.schema["vec_id"].dataType),
        ("component", T.IntegerType()),
        ("n", T.LongType()),
        ("deviation", DEVIATION),
        ("whitened", T.DoubleType()),
        ("explained", T.DoubleType()),
        ("identity_error", T.DoubleType()),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not model:
            return
        schema, m = arrow_schema(fields), json.loads(model)
        n, sums, spread = m["n"], m["sums"], np.array(m["spread"])
        basis = np.array(m["vectors"]).reshape(d, few) / np.where(spread > 0, spread, np.inf)
        widest = max(abs(s) for s in sums)
        for batch in batches:
            for at in range(0, batch.num_rows, PLANE_ROWS):
                x = unpacked(batch.column(1).slice(at, PLANE_ROWS), d)
                reach = n * max(abs(int(x.min())), abs(int(x.max()))) + widest
                if d * reach * reach < 1 << 62:
                    away = n * x - np.array(sums, dtype=np.int64)
                    deviation = pa.array((away * away).sum(axis=1)).cast(pa.decimal128(38, 0))
                else:
                    away = n * x.astype(object) - np.array(sums, dtype=object)
                    exact = [int(v) for v in (away * away).sum(axis=1)]
                    deviation = pa.array([Decimal(v) if v < 10**38 else None for v in exact], type=pa.decimal128(38, 0))
                white = (away / n).astype(np.float64) @ basis
                each = pa.array(np.repeat(np.arange(len(x)), few))
                size = len(each)
                yield batch_of(
                    schema,
                    batch.column(0).slice(at, PLANE_ROWS).take(each),
                    np.tile(np.arange(1, few + 1, dtype=np.int32), len(x)),
                    np.full(size, n, dtype=np.int64),
                    deviation.take(each),
                    white.ravel(),
                    np.tile(np.array(m["explained"], dtype=np.float64), len(x)),
                    np.full(size, m["identity_error"]),
                )

    return rows.drop("length2").mapInArrow(giving_back(run), spark_schema(fields))
