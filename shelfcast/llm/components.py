"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import written

#: Tasks over which the links of one node are spread where they meet the node's smallest neighbour.
SALTS = 8


def _with_low(links: DataFrame, low: DataFrame) -> DataFrame:
    """``links`` (x, y) with ``m`` of ``low`` (x, m); a node with very many links is spread over ``SALTS`` tasks."""
    spread = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return links.withColumn("salt", F.pmod(F.xxhash64("y"), F.lit(SALTS)).cast("int")).join(spread, ["x", "salt"])


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours on to the smallest node among its neighbours and itself."""
    both = links.unionAll(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
    low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    return _with_low(both.where("y > x"), low).select(F.col("y").alias("x"), F.col("m").alias("y"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every node hands itself and its smaller neighbours on to the smallest of them; ``x`` > ``y`` throughout."""
    low = links.groupBy("x").agg(F.min("y").alias("m"))
    moved = _with_low(links, low).select(F.col("y").alias("x"), F.col("m").alias("y")).where("x <> y")
    return moved.unionAll(low.select("x", F.col("m").alias("y")))


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(x, y) links of ordered values -> (node, component), the component being its smallest node.

    Large and small stars take turns until the links no longer change; every node then links to its component. The
    smallest neighbours are plain aggregates, reduced before the shuffle. Rounds grow with the logarithm of the
    nodes, and each is written to the shared folder. Links with a null end and links of a node to itself say nothing
    and are left out; nodes without a link do not appear.
    """
    ends = links.where("x is not null and y is not null and x <> y")
    now = written(ends.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), label)
    mark = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")))
    before = now.select(mark).first()
    while True:
        now = written(_small_star(_large_star(now)).distinct(), label)
        after = now.select(mark).first()
        if after == before:
            return now.select(F.col("x").alias("node"), F.col("y").alias("component")).unionAll(
                now.select(F.col("y").alias("node"), F.col("y").alias("component")).distinct()
            )
        before = after
