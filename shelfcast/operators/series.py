"""Dense daily series and the window features computed on them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def densify(
    facts: DataFrame, keys: list[str], day: str, values: list[str], lo: Column, hi: Column, sparse: list[str] = (), extend: Callable | None = None,
    hold: Callable | None = None,
) -> DataFrame:
    """One row per series and day between ``lo`` and ``hi``, zero where nothing happened.

    ``facts`` has at most one row per series and day. Each fact row is stretched
    up to the day before the next fact of its series, so no table of keys times
    days is joined: only the sparse rows are shuffled, by series, and the dense
    rows come out already grouped for the windows that follow. Columns of
    ``sparse`` stay on the days of their facts and are NULL on the others.
    ``extend`` adds columns that hold for all days of a row, while the rows are sparse. ``hold`` adds columns that
    follow from the others but not from the day, once for each stretch of equal days.
    """
    w = Window.partitionBy(*keys).orderBy(day)
    inside = facts.filter(F.col(day).between(lo, hi))
    start = F.when(F.lag(day).over(w).isNull(), lo).otherwise(F.col(day))
    stop = F.coalesce(F.date_sub(F.lead(day).over(w), 1), hi)
    spread, added = _extended(inside.withColumn("_from", start).withColumn("_to", stop), extend)
    held, more = _extended(_stretches(spread, keys, day, {v: F.col(v) for v in values}, {c: F.col(c) for c in sparse}, added), hold)
    dense = held.withColumn("_day", F.explode(F.sequence("_from", "_to")))
    return dense.select(*keys, F.col("_day").alias(day), *values, *sparse, *added, *more)


def _extended(rows: DataFrame, extend: Callable | None) -> tuple[DataFrame, list[str]]:
    """The rows with the columns that ``extend`` adds, and the names of these."""
    wide = extend(rows) if extend else rows
    return wide, [c for c in wide.columns if c not in rows.columns]


def _stretches(rows: DataFrame, keys: list[str], at: str, values: dict[str, Column], sparse: dict[str, Column], kept: list[str]) -> DataFrame:
    """Sparse rows cut into stretches of equal days: the day ``at`` of a row, and its days before and after.

    Values are zero and sparse columns NULL off the day, so that nothing but the date is left to find for a dense row.
    """
    day = F.col(at)

    def piece(first, last, hit: bool) -> Column:
        return F.struct(first.alias("_from"), last.alias("_to"), F.lit(hit).alias("_hit"))

    pieces = [
        piece(F.col("_from"), F.least(F.date_sub(day, 1), "_to"), False),
        piece(F.greatest(day, "_from"), F.least(day, "_to"), True),
        piece(F.greatest(F.date_add(day, 1), "_from"), F.col("_to"), False),
    ]
    cut = rows.withColumn("_cut", F.explode(F.filter(F.array(*pieces), lambda p: p["_from"] <= p["_to"])))
    hit = F.col("_cut._hit")
    return cut.select(
        *keys, "_cut._from", "_cut._to", *kept,
        *[F.when(hit, c).otherwise(F.lit(0)).alias(v) for v, c in values.items()],
        *[F.when(hit, c).alias(v) for v, c in sparse.items()],
    )


def densify_with_history(
    facts: DataFrame, keys: list[str], day: str, values: list[str], lo: Column, hi: Column, value: str,
    lags=(1, 7), spans=(7, 28), sparse: list[str] = (), sums: dict[str, tuple[Column, int]] | None = None,
    since: Column | None = None, extend: Callable | None = None, hold: Callable | None = None,
) -> DataFrame:
    """``densify`` with ``value`` some days ago (``_lag_k``) and its sums over the days before (``_sum_n``).

    ``sums`` names further whole-number columns that are summed over some days before; they are zero where ``value`` is.

    Both are step functions of the sparse rows: a sale enters a sum on the next day and leaves it ``n`` days later. The
    steps are added up over sparse rows and stretched with them, so no window sorts the dense ones. Like a window over
    the dense days, a lag is NULL before the series has ``k`` days; a sum starts at zero, ``_days`` tells how many
    days it can have seen. Given ``since``, the days before it are lead-in: they count, but get no rows. ``extend`` and ``hold`` are as in ``densify``.
    """
    steps = {}
    sums = {f"_sum_{n}": (F.col(value), n) for n in spans} | (sums or {})
    past = [*((f"_lag_{k}", F.col(value), k, k + 1) for k in lags), *((name, c, 1, n + 1) for name, (c, n) in sums.items())]
    for name, c, first, last in past:
        steps.setdefault(first, {})[name] = c
        steps.setdefault(last, {})[name] = -c
    names = [name for name, *_ in past]
    inside = facts.filter(F.col(day).between(lo, hi))

    # Only the steps are exploded; other columns stand beside them, so that unused ones are not carried along.
    def step(after: int, changes: dict) -> Column:
        fields = [F.date_add(day, after).alias("_at"), F.lit(after == 0).alias("_own")]
        return F.struct(*fields, *[changes.get(n, F.lit(0)).cast("bigint").alias(n) for n in names])

    here = F.array(step(0, {}))
    every = F.array(step(0, {}), *[step(k, c) for k, c in sorted(steps.items())])
    moves = F.explode(F.when(F.coalesce(F.col(value), F.lit(0)) != 0, every).otherwise(here))
    events = inside.withColumn("_m", moves).filter(F.col("_m._at") <= hi)
    own = {c: F.when(F.col("_m._own"), F.col(c)) for c in [*values, *sparse]}
    daily = events.groupBy(*keys, F.col("_m._at").alias("_at")).agg(
        *[F.sum(f"_m.{n}").alias(n) for n in names],
        *[F.sum(own[v]).alias(f"_own_{v}") for v in values],
        *[F.max(own[c]).alias(f"_own_{c}") for c in sparse],
    )
    w = Window.partitionBy(*keys).orderBy("_at")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    spread = daily.withColumns(
        {n: F.sum(n).over(so_far) for n in names}
        | {"_from": F.when(F.lag("_at").over(w).isNull(), lo).otherwise(F.col("_at")), "_to": F.coalesce(F.date_sub(F.lead("_at").over(w), 1), hi)}
    )
    if since is not None:
        spread = spread.withColumn("_from", F.greatest("_from", since)).filter("_from <= _to")
    spread, added = _extended(spread, extend)
    own = {v: F.coalesce(f"_own_{v}", F.lit(0)) for v in values}
    cut = _stretches(spread, keys, "_at", own, {c: F.col(f"_own_{c}") for c in sparse}, [*names, *added])
    held, more = _extended(cut, hold)
    dense = held.withColumn("_day", F.explode(F.sequence("_from", "_to")))
    age = F.datediff("_day", lo)
    return dense.select(
        *keys,
        F.col("_day").alias(day),
        *values,
        *sparse,
        *[F.when(age >= k, F.col(f"_lag_{k}")).alias(f"_lag_{k}") for k in lags],
        *sums,
        age.alias("_days"),
        *added,
        *more,
    )


def densify_with_windows(
    facts: DataFrame, keys: list[str], day: str, values: list[str], lo: Column, hi: Column, value: str, lags=(), spans=(),
    lookback: int | None = None, lag_prefix: str = "qty_lag_", mean_prefix: str = "qty_rolling_",
) -> DataFrame:
    """``densify`` with the columns of ``with_lags``, ``with_rolling_means`` and, given a ``lookback``, ``with_intermittent_stats``.

    The windows are steps of the sparse rows, as in ``densify_with_history``; dense rows are neither sorted nor buffered.
    """
    sold = F.col(value) > 0
    stats = {
        "_sold": (F.when(sold, F.col(value)).otherwise(F.lit(0)), lookback),
        "_sold_days": (F.when(sold, F.lit(1)).otherwise(F.lit(0)), lookback),
    }
    dense = densify_with_history(facts, keys, day, values, lo, hi, value, lags, spans, sums=stats if lookback else None)
    out = [F.col(f"_lag_{k}").alias(f"{lag_prefix}{k}") for k in lags]
    out += [mean_before(n).alias(f"{mean_prefix}{n}d") for n in spans]
    if lookback:
        seen = F.least(F.col("_days"), F.lit(lookback))
        out.append(F.when(F.col("_sold_days") > 0, F.col("_sold").cast("double") / F.col("_sold_days")).alias("nonzero_mean_qty"))
        out.append(F.when(seen > 0, F.col("_sold_days").cast("double") / seen).alias("nonzero_probability"))
    return dense.select(*keys, day, *values, *out, *[f"_sum_{n}" for n in spans])


def mean_before(days: int) -> Column:
    """Mean of the ``days`` days before, or of as many as there are; NULL on the first day."""
    seen = F.least(F.col("_days"), F.lit(days))
    return F.when(seen > 0, F.col(f"_sum_{days}").cast("double") / seen)


def history(keys: list[str], day: str):
    return Window.partitionBy(*keys).orderBy(day)


def trailing(keys: list[str], day: str, rows: int):
    """The ``rows`` rows before the current one; the current row is left out."""
    return history(keys, day).rowsBetween(-rows, -1)


def with_lags(df: DataFrame, keys: list[str], day: str, value: str, lags=(1, 7), prefix: str = "qty_lag_") -> DataFrame:
    w = history(keys, day)
    return df.withColumns({f"{prefix}{k}": F.lag(value, k).over(w) for k in lags})


def with_rolling_means(
    df: DataFrame, keys: list[str], day: str, value: str, spans=(7, 28), prefix: str = "qty_rolling_", suffix: str = "d"
) -> DataFrame:
    return df.withColumns(
        {f"{prefix}{n}{suffix}": F.avg(F.col(value).cast("double")).over(trailing(keys, day, n)) for n in spans}
    )


def segment_of(total: Column) -> Column:
    """Demand class of a trailing 28-day sum; NULL counts as low."""
    return F.when(total >= 12, "high").when(total >= 3, "medium").otherwise("low")


def with_segment(df: DataFrame, keys: list[str], day: str, value: str, days: int = 28) -> DataFrame:
    total = F.sum(value).over(trailing(keys, day, days))
    return df.withColumn("demand_segment", segment_of(total))


def with_intermittent_stats(df: DataFrame, keys: list[str], day: str, value: str, days: int = 56) -> DataFrame:
    """Mean of the non-zero days and share of non-zero days in the trailing window."""
    w = trailing(keys, day, days)
    sold = F.col(value) > 0
    return df.withColumns(
        {
            "nonzero_mean_qty": F.avg(F.when(sold, F.col(value).cast("double"))).over(w),
            "nonzero_probability": F.avg(F.when(sold, F.lit(1.0)).otherwise(F.lit(0.0))).over(w),
        }
    )


def last_days(df: DataFrame, day: str, days: int, newest: Column | None = None) -> DataFrame:
    """Rows of the last ``days`` days. Pass ``newest`` when it is known from a cheaper
    table; otherwise the newest day is looked up in ``df`` itself."""
    end = newest if newest is not None else df.agg(F.max(day).alias("d")).scalar()
    return df.filter(F.col(day) > F.date_sub(end, days))
