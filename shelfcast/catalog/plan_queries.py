"""Backtests, gates, forecasts, decisions and models (U1, A14 to A24, F5 to F33)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog import fixtures as fx
from shelfcast.catalog.join_queries import SLICE_SQL, wh_panel
from shelfcast.catalog.reference_sql import TABLES
from shelfcast.catalog.registry import query
from shelfcast.catalog.series_queries import STORE, STORE_DAYS, WH, store_panel, train_store
from shelfcast.catalog.util import rounded
from shelfcast.domain import locations_static, store_location_map
from shelfcast.operators import scoring, sketches
from shelfcast.operators.series import last_days
from shelfcast.plans import backtest, gates, models, policy, stock, training
from shelfcast.sources import tables


def held_store(spark, sf):
    """The last fourteen days of the store training table."""
    return last_days(train_store(spark, sf, 14 + 28, 14), "feature_date", 14, fx.newest_sale(spark, sf))


def stored_train(spark, sf, last=None, shown=None):
    """The store training table, written once for jobs that read it several times."""
    return tables.through_disk(spark, train_store(spark, sf, last, shown), "train-store")


def metrics_sql(source: str, group: str, quantiles=(0.5, 0.9, 0.95), extra: str = "") -> str:
    """Error metrics of rows with ``actual`` and ``predicted``."""
    names = {0.5: "p50_abs_error", 0.9: "p90_abs_error", 0.95: "p95_abs_error"}
    tails = ", ".join(f"round(quantile_cont(abs(actual - predicted), {q}), 5) AS {names[q]}" for q in quantiles)
    return f"""
SELECT {group}, count(*) AS row_count, round(sum(actual), 5) AS actual_sum, round(sum(predicted), 5) AS predicted_sum,
       round(avg(abs(actual - predicted)), 5) AS mae, round(sqrt(avg((actual - predicted) * (actual - predicted))), 5) AS rmse,
       round(sum(abs(actual - predicted)) / nullif(sum(abs(actual)), 0), 5) AS wape,
       round(avg(abs(actual - predicted) / nullif((abs(actual) + abs(predicted)) / 2, 0)), 5) AS smape, round(avg(predicted - actual), 5) AS bias,
       round(avg(CASE WHEN predicted < actual THEN 1.0 ELSE 0.0 END), 5) AS underforecast_rate,
       round(sum(greatest(actual - predicted, 0)), 5) AS underforecast_units, round(sum(greatest(predicted - actual, 0)), 5) AS overforecast_units,
       round(1 - sum(greatest(actual - predicted, 0)) / nullif(sum(abs(actual)), 0), 5) AS fill_rate_proxy, {tails}{extra}
FROM ({source}) GROUP BY {group}
"""


TABLES["base_wh"] = """
SELECT feature_date, isbn13, wh_id, CAST(qty_sold AS DOUBLE) AS actual,
       coalesce(avg(qty_sold) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0) AS ma_7d,
       coalesce(avg(qty_sold) OVER (w ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), 0) AS ma_28d,
       CAST(coalesce(lag(qty_sold, 7) OVER w, 0) AS DOUBLE) AS same_weekday
FROM panel_wh WINDOW w AS (PARTITION BY isbn13, wh_id ORDER BY feature_date)
"""
STACK_WH = """
SELECT m.model, actual, CASE m.model WHEN 'ma_7d' THEN ma_7d WHEN 'ma_28d' THEN ma_28d ELSE same_weekday END AS predicted
FROM base_wh, (VALUES ('ma_7d'), ('ma_28d'), ('same_weekday')) AS m(model) WHERE feature_date > (SELECT max(feature_date) FROM base_wh) - {days}
"""


@query("baseline_stack", f"SELECT model, actual, round(predicted, 4) AS predicted FROM ({STACK_WH.format(days=28)})")
def baseline_stack(spark, sf):
    return rounded(backtest.baseline_scores(wh_panel(spark, sf, 56, windows=backtest.BASELINES), WH, newest=fx.newest_sale(spark, sf)))


@query("baseline_backtest", metrics_sql(STACK_WH.format(days=28), "model", (0.5, 0.9)))
def baseline_backtest(spark, sf):
    return rounded(backtest.baseline_backtest(wh_panel(spark, sf, 56, windows=backtest.BASELINES), WH, newest=fx.newest_sale(spark, sf)), 5)


@query("forecast_error_metrics", metrics_sql(STACK_WH.format(days=100000), "model"))
def forecast_error_metrics(spark, sf):
    scored = backtest.baseline_scores(wh_panel(spark, sf, windows=backtest.BASELINES), WH, 100_000, newest=fx.newest_sale(spark, sf), counted=True)
    return rounded(scoring.error_metrics(scored, ["model"], weight="_n"), 5)


def stored_errors(spark, sf):
    """Absolute errors of the last 56 days by model and day."""
    scored = backtest.baseline_scores(wh_panel(spark, sf, 84, windows=backtest.BASELINES), WH, 56, newest=fx.newest_sale(spark, sf), keep=["feature_date"])
    errors = scored.select("model", "feature_date", F.abs(F.col("actual") - F.col("predicted")).alias("err"))
    return tables.through_disk(spark, errors, "errors")


@query(
    "error_sketch_periods",
    " UNION ALL ".join(
        f"SELECT '{days} days' AS period, model, count(*) AS row_count, true AS p50_in_bound, true AS p90_in_bound FROM ({STACK_WH.format(days=days)}) GROUP BY 2"
        for days in (56, 28)
    ),
)
def error_sketch_periods(spark, sf):
    """Quantiles of two periods merged from the same stored sketches by day, and whether their exact ranks are within the bound."""
    names, errors = {"p50": 0.5, "p90": 0.9}, stored_errors(spark, sf)
    stored = tables.through_disk(spark, sketches.sketch_by(errors, ["model", "feature_date"], "err"), "error-sketches")
    out = []
    for days in (56, 28):
        among = F.col("feature_date") > F.date_sub(fx.newest_sale(spark, sf), days)
        merged = sketches.merged_quantiles(stored, ["model"], names, among)
        shares = {f"{q}_{side}": c for q in names for side, c in sketches.rank_shares("err", q).items()}
        ranks = errors.filter(among).join(F.broadcast(merged), "model").groupBy("model", "n").agg(*[c.alias(n) for n, c in shares.items()])  # a row a model
        near = [
            ((F.col(f"{n}_below") <= q + sketches.rank_error()) & (F.col(f"{n}_upto") >= q - sketches.rank_error())).alias(f"{n}_in_bound") for n, q in names.items()
        ]
        out.append(ranks.select(F.lit(f"{days} days").alias("period"), "model", F.col("n").alias("row_count"), *near))
    return out[0].unionByName(out[1])


SEGMENT_SQL = """
SELECT s.seg AS demand_segment, CAST(qty_sold AS DOUBLE) AS actual, coalesce(qty_rolling_28d, 0) AS predicted
FROM train_store t, (VALUES (true), (false)) AS a(is_all), LATERAL (SELECT CASE WHEN a.is_all THEN 'all' ELSE t.demand_segment END AS seg) s
WHERE feature_date > (SELECT max(feature_date) FROM train_store) - 14
"""


def segment_scores(spark, sf):
    held = held_store(spark, sf)
    scored = scoring.stack_models(held, {"ma28": backtest.zero("qty_rolling_28d")}, ["demand_segment"], "qty_sold")
    return scoring.with_total_segment(scored.drop("model"))


@query("segment_error_metrics", metrics_sql(SEGMENT_SQL, "demand_segment"))
def segment_error_metrics(spark, sf):
    return rounded(scoring.error_metrics(segment_scores(spark, sf), ["demand_segment"]), 5)


@query(
    "order_cost",
    metrics_sql(
        SEGMENT_SQL, "demand_segment", (0.5, 0.9, 0.95),
        """, round(sum(greatest(actual - predicted, 0)) * 3 + sum(greatest(predicted - actual, 0)), 5) AS weighted_order_cost,
           round((sum(greatest(actual - predicted, 0)) * 3 + sum(greatest(predicted - actual, 0))) / nullif(sum(actual), 0), 5) AS weighted_order_cost_rate""",
    ),
)
def order_cost(spark, sf):
    return rounded(scoring.order_cost(scoring.error_metrics(segment_scores(spark, sf), ["demand_segment"])), 5)


TABLES["base_store"] = """
SELECT feature_date, demand_segment, CAST(qty_sold AS DOUBLE) AS actual, coalesce(avg(qty_sold) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0) AS ma_7d,
       coalesce(avg(qty_sold) OVER (w ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), 0) AS ma_28d, CAST(coalesce(lag(qty_sold, 7) OVER w, 0) AS DOUBLE) AS same_weekday,
       coalesce(avg(CASE WHEN qty_sold > 0 THEN qty_sold END) OVER (w ROWS BETWEEN 56 PRECEDING AND 1 PRECEDING), 0)
       * coalesce(avg(CASE WHEN qty_sold > 0 THEN 1.0 ELSE 0.0 END) OVER (w ROWS BETWEEN 56 PRECEDING AND 1 PRECEDING), 0) AS expected,
       max(feature_date) OVER () AS newest
FROM panel_segment WINDOW w AS (PARTITION BY isbn13, store_id ORDER BY feature_date)
"""
TABLES["factors_store"] = """
SELECT model, demand_segment, least(2.0, greatest(0.5, coalesce(sum(actual) / nullif(sum(predicted), 0), 1.0))) AS calibration_factor FROM (
  SELECT m.model, demand_segment, actual, CASE m.model WHEN 'ma_7d' THEN ma_7d WHEN 'ma_28d' THEN ma_28d ELSE expected END AS predicted
  FROM base_store, (VALUES ('ma_7d'), ('ma_28d'), ('intermittent_probability_mean')) AS m(model)
  WHERE feature_date > newest - 28 AND feature_date <= newest - 14) GROUP BY 1, 2
"""
TABLES["scores_store"] = """
SELECT m.model, h.demand_segment, h.actual,
  CASE m.source WHEN 'ma_7d' THEN h.ma_7d WHEN 'ma_28d' THEN h.ma_28d WHEN 'same_weekday' THEN h.same_weekday ELSE h.expected END
  * CASE WHEN m.model LIKE 'calibrated%' THEN coalesce(c.calibration_factor, 1.0) WHEN m.model LIKE 'sba%' THEN 0.95 ELSE 1.0 END AS predicted
FROM base_store h CROSS JOIN (VALUES ('ma_7d', 'ma_7d'), ('ma_28d', 'ma_28d'), ('same_weekday', 'same_weekday'),
  ('intermittent_probability_mean', 'intermittent_probability_mean'), ('sba_adjusted_intermittent', 'intermittent_probability_mean'),
  ('calibrated_ma_7d', 'ma_7d'), ('calibrated_ma_28d', 'ma_28d'), ('calibrated_intermittent_probability_mean', 'intermittent_probability_mean')) AS m(model, source)
LEFT JOIN factors_store c ON c.model = m.source AND c.demand_segment = h.demand_segment
WHERE h.feature_date > h.newest - 14
"""
INTERMITTENT_SQL = metrics_sql("SELECT * FROM scores_store", "model, demand_segment", (0.5, 0.9), ", sum(abs(actual - predicted)) / nullif(sum(abs(actual)), 0) < 1 AS passed")


def intermittent(spark, sf):
    return backtest.intermittent_backtest(store_panel(spark, sf, 28 + 56, backtest.INTERMITTENT), STORE, newest=fx.newest_sale(spark, sf))


@query("calibration_factor", "SELECT model, demand_segment, round(calibration_factor, 4) AS calibration_factor FROM factors_store")
def calibration_factor(spark, sf):
    return rounded(backtest.intermittent_scores(store_panel(spark, sf, 28 + 56, backtest.INTERMITTENT), STORE, newest=fx.newest_sale(spark, sf))[1])


@query("intermittent_backtest", INTERMITTENT_SQL)
def intermittent_backtest(spark, sf):
    return rounded(intermittent(spark, sf), 5)


BEST_SQL = """
SELECT demand_segment, model, wape FROM (SELECT demand_segment, model, wape, row_number() OVER (PARTITION BY demand_segment ORDER BY wape, model) AS rn FROM (
  SELECT demand_segment, model, round(sum(abs(actual - predicted)) / nullif(sum(abs(actual)), 0), 4) AS wape FROM scores_store GROUP BY 1, 2) WHERE wape IS NOT NULL) WHERE rn = 1
"""


@query("best_by_segment", BEST_SQL)
def best_by_segment(spark, sf):
    return scoring.best_by_segment(rounded(intermittent(spark, sf))).select("demand_segment", "model", "wape")


TABLES["held_store"] = "SELECT * FROM train_store WHERE feature_date > (SELECT max(feature_date) FROM train_store) - 14"


def uplift_sql(name, label, ref, extra):
    return f"""SELECT '{name}' AS check_name, {label} AS segment, count(*) AS row_count, round(avg(qty_sold), 4) AS metric_1,
        round(avg(qty_sold) / nullif((SELECT avg(qty_sold) FROM held_store WHERE {ref}), 0), 4) AS metric_2, round(avg({extra}), 4) AS metric_3, true AS passed
        FROM held_store GROUP BY 2"""


LOUD = "(sns_mentions_1d >= 100 OR sns_mentions_7d >= 400)"
NEAR = "(event_nearby_days BETWEEN 0 AND 2 OR holiday_flag = 1)"
UPLIFT_SQL = " UNION ALL ".join(
    [
        uplift_sql("store_size_uplift", "store_size", "true", "on_hand"),
        uplift_sql("sns_uplift", f"CASE WHEN {LOUD} THEN 'high_sns' ELSE 'normal_sns' END", f"NOT {LOUD}", "sns_mentions_1d"),
        uplift_sql("event_uplift", f"CASE WHEN {NEAR} THEN 'event_window' ELSE 'normal_day' END", f"NOT {NEAR}", "event_nearby_days"),
        uplift_sql("bestseller_uplift", "CASE WHEN bestseller_flag = 1 THEN 'bestseller' ELSE 'non_bestseller' END", "bestseller_flag <> 1", "sales_point"),
    ]
)


@query("uplift_screen", UPLIFT_SQL)
def uplift_screen(spark, sf):
    return rounded(backtest.uplift_checks(tables.through_disk(spark, held_store(spark, sf), "held"), 100, 400))


SCREEN_SQL = f"""
SELECT 'baseline_ma28' AS check_name, demand_segment AS segment, count(*) AS row_count,
       round(sum(abs(qty_sold - coalesce(qty_rolling_28d, 0))) / nullif(sum(abs(qty_sold)), 0), 4) AS metric_1,
       round(avg(abs(qty_sold - coalesce(qty_rolling_28d, 0))), 4) AS metric_2,
       round(quantile_cont(abs(qty_sold - coalesce(qty_rolling_28d, 0)), 0.9), 4) AS metric_3,
       sum(abs(qty_sold - coalesce(qty_rolling_28d, 0))) / nullif(sum(abs(qty_sold)), 0) < 1 AS passed FROM held_store GROUP BY 2
UNION ALL {UPLIFT_SQL}
"""


@query("feature_screen", SCREEN_SQL)
def feature_screen(spark, sf):
    return rounded(backtest.feature_screen(stored_train(spark, sf, 14 + 28, 14), 14, 100, 400))


PIVOT_SQL = f"""
SELECT max(metric_2) FILTER (check_name = 'event_uplift' AND segment = 'event_window') AS event_uplift,
       max(metric_2) FILTER (check_name = 'sns_uplift' AND segment = 'high_sns') AS sns_uplift,
       max(metric_2) FILTER (check_name = 'bestseller_uplift' AND segment = 'bestseller') AS bestseller_uplift,
       max(metric_2) FILTER (check_name = 'store_size_uplift' AND segment = 'L') AS large_store_uplift FROM ({UPLIFT_SQL})
"""


@query("pivot_checks", PIVOT_SQL)
def pivot_checks(spark, sf):
    return gates.pivot_checks(uplift_screen(spark, sf))


GATE_SQL = f"""
WITH t AS (
  SELECT count(*) AS row_count, count(DISTINCT isbn13 || '#' || store_id) AS series_count, min(feature_date) AS min_feature_date, max(feature_date) AS max_feature_date,
         round(CAST(count(*) FILTER (qty_sold = 0) AS DOUBLE) / count(*), 4) AS zero_sales_ratio,
         round(CAST(count(*) FILTER (day_of_week IS NULL OR month IS NULL OR weekend_flag IS NULL OR bestseller_flag IS NULL OR store_id IS NULL OR wh_id IS NULL) AS DOUBLE)
               / count(*), 4) AS required_null_ratio, count(DISTINCT store_id) AS store_count, CAST(2 AS BIGINT) AS data_lag_days FROM train_store_all),
b AS (SELECT max(wape) FILTER (demand_segment = 'high') AS high_best_wape, max(wape) FILTER (demand_segment = 'medium') AS medium_best_wape,
             max(wape) FILTER (demand_segment = 'low') AS low_best_wape FROM ({BEST_SQL})),
p AS ({PIVOT_SQL})
SELECT t.*, b.*, p.*, row_count >= 1000000 AND store_count = 14 AND series_count >= 14000 AND data_lag_days <= 1 AND required_null_ratio <= 0.01
  AND high_best_wape <= 0.85 AND medium_best_wape <= 1.05 AND coalesce(low_best_wape <= 1.05, true) AND event_uplift >= 1.05
  AND bestseller_uplift >= 1.15 AND large_store_uplift >= 1.02 AS pretrain_gate_passed,
  concat_ws(';', CASE WHEN row_count < 1000000 THEN 'row_count_below_1m' END, CASE WHEN store_count <> 14 THEN 'store_count_not_14' END,
    CASE WHEN series_count < 14000 THEN 'series_count_below_14000' END, CASE WHEN data_lag_days > 1 THEN 'data_stale' END,
    CASE WHEN required_null_ratio > 0.01 THEN 'required_null_ratio_above_1pct' END, CASE WHEN high_best_wape > 0.85 THEN 'high_wape_above_0_85' END,
    CASE WHEN medium_best_wape > 1.05 THEN 'medium_wape_above_1_05' END, CASE WHEN low_best_wape > 1.05 THEN 'low_wape_above_1_05' END,
    CASE WHEN event_uplift < 1.05 THEN 'event_uplift_below_1_05' END, CASE WHEN bestseller_uplift < 1.15 THEN 'bestseller_uplift_below_1_15' END,
    CASE WHEN large_store_uplift < 1.02 THEN 'large_store_uplift_below_1_02' END) AS reject_reasons
FROM t, b, p
"""


@query("pretrain_gate", GATE_SQL)
def pretrain_gate(spark, sf):
    # The whole table is read once, for its metrics; the backtest and the uplifts read its last days, with the columns they use.
    required = ["day_of_week", "month", "weekend_flag", "bestseller_flag", "store_id", "wh_id"]
    metrics = rounded(gates.training_metrics(train_store(spark, sf), STORE, required, place="store_id"))
    newest, seen = fx.newest_sale(spark, sf), 2 * 14 + 56  # scored days and lead-in of the backtest
    recent = train_store(spark, sf, seen + 28, seen).select(*STORE, "feature_date", "qty_sold", "demand_segment")
    best = scoring.best_by_segment(rounded(backtest.intermittent_backtest(tables.through_disk(spark, recent, "recent"), STORE, newest=newest)))
    run = F.date_add(newest, 2)
    return gates.pretrain_gate(metrics, best, uplift_screen(spark, sf), run)


@query(
    "promotion_gate",
    f"""WITH m AS ({metrics_sql(SEGMENT_SQL, 'demand_segment')}),
    o AS (SELECT coalesce(max(wape) FILTER (demand_segment = 'all'), 999) AS all_wape, coalesce(max(wape) FILTER (demand_segment = 'high'), 999) AS high_wape,
      coalesce(max(wape) FILTER (demand_segment = 'medium'), 999) AS medium_wape, coalesce(max(fill_rate_proxy) FILTER (demand_segment = 'all'), 0) AS all_fill_rate,
      coalesce(max(fill_rate_proxy) FILTER (demand_segment = 'high'), 0) AS high_fill_rate,
      coalesce(max(underforecast_rate) FILTER (demand_segment = 'all'), 1) AS all_underforecast_rate,
      coalesce(max(underforecast_rate) FILTER (demand_segment = 'high'), 1) AS high_underforecast_rate FROM m)
    SELECT *, reject_reasons = '' AS passed FROM (SELECT *, concat_ws(';', CASE WHEN all_wape > 0.526 THEN 'all_wape_above_threshold' END,
      CASE WHEN high_wape > 0.522 THEN 'high_wape_above_threshold' END, CASE WHEN medium_wape > 1.005 THEN 'medium_wape_above_threshold' END,
      CASE WHEN all_fill_rate < 0.82 THEN 'all_fill_rate_below_threshold' END, CASE WHEN high_fill_rate < 0.82 THEN 'high_fill_rate_below_threshold' END,
      CASE WHEN all_underforecast_rate > 0.58 THEN 'all_underforecast_rate_above_threshold' END,
      CASE WHEN high_underforecast_rate > 0.58 THEN 'high_underforecast_rate_above_threshold' END) AS reject_reasons FROM o)""",
)
def promotion_gate(spark, sf):
    return gates.promotion_gate(segment_error_metrics(spark, sf))


# Forecast rows, scoring rules and allocation.

FUTURE_SQL = """
SELECT l.* EXCLUDE (feature_date, rn) REPLACE (0 AS holiday_flag, dayofweek(l.feature_date + k) + 1 AS day_of_week, CAST(month(l.feature_date + k) AS BIGINT) AS month,
         CAST(dayofweek(l.feature_date + k) IN (0, 6) AS INTEGER) AS weekend_flag, greatest(event_nearby_days - k, 0) AS event_nearby_days,
         book_age_days + k AS book_age_days, days_since_last_stockout + k AS days_since_last_stockout), l.feature_date + k AS target_date
FROM (SELECT *, row_number() OVER (PARTITION BY isbn13, store_id ORDER BY feature_date DESC) AS rn FROM train_store) l, (VALUES (1), (2), (3), (4), (5)) AS o(k) WHERE rn = 1
"""


def future_rows(spark, sf):
    return policy.future_features(train_store(spark, sf, 29, 1), STORE, 5)


@query("future_features", f"SELECT * REPLACE (round(qty_rolling_7d, 4) AS qty_rolling_7d, round(qty_rolling_28d, 4) AS qty_rolling_28d) FROM ({FUTURE_SQL})")
def future_features(spark, sf):
    return rounded(future_rows(spark, sf))


ALLOCATION_INPUT = """
SELECT prediction_date, target_date, f.isbn13, CAST(l.wh_id AS BIGINT) AS wh_id, sum(coalesce(predicted_demand, 0)) AS predicted_demand,
       sum(confidence_low) AS confidence_low, sum(confidence_high) AS confidence_high
FROM forecast_results f JOIN locations_static l ON l.location_id = f.store_id
WHERE prediction_date = (SELECT max(prediction_date) FROM forecast_results) GROUP BY 1, 2, 3, 4
"""
STORES_SQL = "SELECT CAST(location_id AS BIGINT) AS store_id, CAST(wh_id AS BIGINT) AS wh_id, count(*) OVER (PARTITION BY wh_id) AS store_count FROM locations_static WHERE location_type LIKE 'STORE%'"
RECENT_SQL = "SELECT isbn13, wh_id, store_id, sum(qty_sold) AS store_qty FROM sales_fact WHERE sale_date >= (SELECT max(sale_date) FROM sales_lines) - 28 GROUP BY 1, 2, 3"


def allocation_sql(share):
    return f"""WITH wp AS ({ALLOCATION_INPUT}), st AS ({STORES_SQL}), rs AS ({RECENT_SQL})
SELECT wp.prediction_date, wp.target_date, wp.isbn13, sh.store_id, round(sum(wp.predicted_demand * sh.share), 9) AS predicted_demand,
       round(sum(wp.confidence_low * sh.share), 9) AS confidence_low, round(sum(wp.confidence_high * sh.share), 9) AS confidence_high
FROM wp JOIN ({share}) sh ON sh.isbn13 = wp.isbn13 AND sh.wh_id = wp.wh_id GROUP BY 1, 2, 3, 4"""


def wh_forecasts(spark, sf):
    rows = fx.forecast_results(spark, sf)
    newest = fx.newest_sale(spark, sf)
    place = locations_static(spark).select(F.col("location_id").cast("bigint").alias("store_id"), F.col("wh_id").cast("bigint").alias("wh_id"))
    values = ["predicted_demand", "confidence_low", "confidence_high"]
    return rows.filter(F.col("prediction_date") == newest).join(place, "store_id").groupBy("prediction_date", "target_date", "isbn13", "wh_id").agg(
        *[F.sum(F.coalesce(v, F.lit(0.0))).alias(v) for v in values]
    )


def allocation(spark, sf, mode):
    since = F.date_sub(fx.newest_sale(spark, sf), 28)
    return rounded(
        policy.allocate_to_stores(wh_forecasts(spark, sf), fx.sales_fact(spark, sf), store_location_map(spark), locations_static(spark), since, mode),
        9,
    )


@query(
    "store_allocation",
    allocation_sql(
        """SELECT k.isbn13, st.wh_id, st.store_id, CASE WHEN coalesce(t.q, 0) > 0 THEN coalesce(CAST(rs.store_qty AS DOUBLE) / t.q, 0) ELSE 1.0 / st.store_count END AS share
           FROM (SELECT DISTINCT isbn13, wh_id FROM wp) k JOIN st ON st.wh_id = k.wh_id LEFT JOIN rs ON rs.isbn13 = k.isbn13 AND rs.store_id = st.store_id
           LEFT JOIN (SELECT isbn13, wh_id, sum(store_qty) AS q FROM rs GROUP BY 1, 2) t ON t.isbn13 = k.isbn13 AND t.wh_id = k.wh_id"""
    ),
)
def store_allocation(spark, sf):
    return allocation(spark, sf, "normalized")


@query(
    "store_allocation_as_written",
    allocation_sql(
        """SELECT w.isbn13, st.wh_id, st.store_id, coalesce(CAST(rs.store_qty AS DOUBLE) / sum(rs.store_qty) OVER (PARTITION BY w.isbn13, st.wh_id), 1.0 / st.store_count) AS share
           FROM wp w JOIN st ON st.wh_id = w.wh_id LEFT JOIN rs ON rs.isbn13 = w.isbn13 AND rs.wh_id = st.wh_id AND rs.store_id = st.store_id"""
    ),
)
def store_allocation_as_written(spark, sf):
    return allocation(spark, sf, "as_written")


@query(
    "series_forecast",
    """WITH s AS (SELECT *, max(feature_date) OVER () AS newest FROM (
                    SELECT feature_date, isbn13, wh_id, CAST(qty_sold AS DOUBLE) AS q, coalesce(avg(qty_sold) OVER (PARTITION BY isbn13, wh_id ORDER BY feature_date
                           ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), 0) AS ma FROM panel_wh)),
            f AS (SELECT isbn13, wh_id, max(newest) AS newest, avg(q) FILTER (newest - feature_date < 28) AS lvl, avg(q) AS mean, sqrt(avg((q - ma) * (q - ma))) AS sigma
                  FROM s WHERE feature_date > newest - 112 GROUP BY 1, 2),
            d AS (SELECT isbn13, wh_id, dayofweek(feature_date) AS dow, avg(q) AS dq FROM s WHERE feature_date > newest - 112 GROUP BY 1, 2, 3),
            p AS (SELECT f.*, f.newest + k AS target_date, greatest(f.lvl * coalesce(d.dq / nullif(f.mean, 0), 1), 0) AS v FROM f CROSS JOIN (VALUES (1), (2), (3), (4), (5)) AS o(k)
                  LEFT JOIN d ON d.isbn13 = f.isbn13 AND d.wh_id = f.wh_id AND d.dow = dayofweek(f.newest + k))
       SELECT newest AS prediction_date, target_date, isbn13, wh_id, round(v, 6) AS predicted_demand, round(greatest(v - 1.2816 * sigma, 0), 6) AS confidence_low,
              round(v + 1.2816 * sigma, 6) AS confidence_high FROM p""",
)
def series_forecast(spark, sf):
    return rounded(models.series_forecast(wh_panel(spark, sf, 112 + 28), WH, newest=fx.newest_sale(spark, sf)), 6)


RULES = [
    {"column": "store_size", "value": "L", "segment": "high", "multiplier": 1.1},
    {"column": "price_tier", "value": "LOW", "segment": "medium", "multiplier": 1.05},
    {"column": "channel", "value": "online", "segment": "high", "multiplier": 1.02},
]
MULTIPLIERS = {"high": 1.2, "medium": 1.35}
SCORE = "0.6 * coalesce(qty_rolling_7d, 0) + 0.4 * coalesce(qty_lag_7, 0) - 0.5"
POLICY_SQL = f"""
SELECT isbn13, store_id, feature_date, demand_segment, predicted AS predicted_demand FROM (
  SELECT *, greatest(CASE WHEN demand_segment = 'high' THEN greatest({SCORE}, 0) WHEN demand_segment = 'medium' THEN coalesce(qty_rolling_7d, 0)
                          ELSE coalesce(qty_rolling_28d, 0) END, 0)
    * CASE demand_segment WHEN 'high' THEN 1.2 WHEN 'medium' THEN 1.35 ELSE 1 END
    * CASE WHEN demand_segment = 'high' AND store_size = 'L' THEN 1.1 ELSE 1 END * CASE WHEN demand_segment = 'medium' AND price_tier = 'LOW' THEN 1.05 ELSE 1 END
    * CASE WHEN demand_segment = 'high' AND channel = 'online' THEN 1.02 ELSE 1 END AS predicted FROM held_store)
"""


def policy_rows(spark, sf):
    held = held_store(spark, sf)
    out = policy.policy_predict(held, F.expr(SCORE), MULTIPLIERS, RULES, model_segments=("high",), medium="ma7", low="ma28")
    return out.select("isbn13", "store_id", "feature_date", "demand_segment", "predicted_demand")


@query("policy_predict", f"SELECT * REPLACE (round(predicted_demand, 4) AS predicted_demand) FROM ({POLICY_SQL})")
def policy_predict(spark, sf):
    return rounded(policy_rows(spark, sf))


@query(
    "confidence_bounds",
    f"""SELECT *  REPLACE (round(predicted_demand, 4) AS predicted_demand),
               round(CASE demand_segment WHEN 'high' THEN predicted_demand / 1.2 WHEN 'medium' THEN predicted_demand / 1.35 ELSE predicted_demand * 0.75 END, 4) AS confidence_low,
               round(CASE demand_segment WHEN 'high' THEN predicted_demand * least(1.18, 1 + 0.2 / 3) WHEN 'medium' THEN predicted_demand * least(1.18, 1 + 0.35 / 3)
                     ELSE predicted_demand * 1.25 END, 4) AS confidence_high FROM ({POLICY_SQL})""",
)
def confidence_bounds(spark, sf):
    return rounded(policy.confidence_bounds(policy_rows(spark, sf), MULTIPLIERS))


TABLES["ratio_store"] = """
SELECT *, qty_sold / greatest(coalesce(qty_rolling_28d, 0), 0.05) AS ratio FROM held_store
"""


def multiplier_rows(spark, sf):
    held = held_store(spark, sf)
    keep = ["demand_segment", "store_size", "channel", "price_tier", "day_of_week"]
    return scoring.stack_models(held, {"ma28": backtest.zero("qty_rolling_28d")}, keep, "qty_sold")


@query(
    "segment_multipliers",
    "SELECT demand_segment, round(least(greatest(quantile_cont(ratio, 0.9), 1), 8), 4) AS multiplier FROM ratio_store GROUP BY 1",
)
def segment_multipliers(spark, sf):
    return rounded(backtest.segment_multipliers(multiplier_rows(spark, sf), cap=8.0))


@query(
    "group_multipliers",
    """SELECT * FROM (SELECT c AS "column", v AS value, segment, round(least(greatest(quantile_cont(ratio, 0.9), 1), 6), 4) AS multiplier, count(*) AS train_rows FROM (
         SELECT unnest(['store_size', 'channel', 'price_tier', 'day_of_week']) AS c, unnest([store_size, channel, price_tier, CAST(day_of_week AS VARCHAR)]) AS v,
                demand_segment AS segment, ratio FROM ratio_store) GROUP BY 1, 2, 3 HAVING count(*) >= 20)
       WHERE multiplier > 1.001 ORDER BY multiplier DESC, train_rows DESC, 1, 2, 3 LIMIT 24""",
)
def group_multipliers(spark, sf):
    columns = ["store_size", "channel", "price_tier", "day_of_week"]
    return rounded(backtest.group_multipliers(multiplier_rows(spark, sf), columns, service_level=0.9, cap=6.0, min_rows=20))


@query(
    "ensemble_weights",
    """WITH h AS (SELECT CAST(qty_sold AS DOUBLE) AS actual, demand_segment, coalesce(qty_rolling_7d, 0) AS m1, coalesce(qty_rolling_28d, 0) AS m2,
                         CAST(coalesce(qty_lag_7, 0) AS DOUBLE) AS m3 FROM held_store),
            w AS (SELECT a / 10.0 AS w1, b / 10.0 AS w2, (10 - a - b) / 10.0 AS w3 FROM generate_series(0, 10) AS x(a), generate_series(0, 10) AS y(b) WHERE a + b <= 10),
            c AS (SELECT w1, w2, w3, actual, demand_segment, m1 * w1 + m2 * w2 + m3 * w3 AS p FROM h, w),
            g AS (SELECT CAST(w1 AS DOUBLE) AS w1, CAST(w2 AS DOUBLE) AS w2, CAST(w3 AS DOUBLE) AS w3, sum(actual) AS a, sum(greatest(actual - p, 0)) AS u, sum(greatest(p - actual, 0)) AS o,
                         sum(greatest(actual - p, 0)) FILTER (demand_segment = 'high') AS hu, sum(actual) FILTER (demand_segment = 'high') AS ha,
                         count(*) FILTER (round(p, 6) < actual) / count(*) AS late FROM c GROUP BY 1, 2, 3),
            r AS (SELECT w1, w2, w3, (u * 3 + o) / a AS rate, (u + o) / a AS wape, 1 - u / a AS fill, late,
                         (u * 3 + o) / a + 10 * (greatest(0.82 - (1 - u / a), 0) + greatest(0.82 - coalesce(1 - hu / ha, 1 - u / a), 0)) AS score FROM g)
       SELECT w1, w2, w3, round(rate, 4) AS weighted_order_cost_rate, round(wape, 4) AS wape, round(fill, 4) AS fill_rate_proxy, round(late, 4) AS underforecast_rate,
              round(score, 4) AS score, CAST(row_number() OVER (ORDER BY round(score, 8), round(rate, 8), round(wape, 8), w1, w2) AS INTEGER) AS rank FROM r""",
)
def ensemble_weights(spark, sf):
    held = held_store(spark, sf).select(
        F.col("qty_sold").cast("double").alias("actual"), "demand_segment", backtest.zero("qty_rolling_7d").alias("m1"),
        backtest.zero("qty_rolling_28d").alias("m2"), F.coalesce(F.col("qty_lag_7").cast("double"), F.lit(0.0)).alias("m3"),
    )
    return rounded(backtest.ensemble_weights(held, ["m1", "m2", "m3"]))


def fitted_demand(spark, sf, name, loss):
    """Error metrics of a fitted demand model on the holdout, next to the 28-day mean."""
    split = training.holdout_split(train_store(spark, sf, STORE_DAYS, 134), newest=fx.newest_sale(spark, sf))
    stored = tables.through_disk(spark, split, "split")  # read often while fitting
    model = models.train_demand_model(stored, loss=loss)
    held = models.score_demand(model, stored.filter("split_name = 'holdout'"))
    scored = scoring.stack_models(held, {name: F.col("score"), "ma28": backtest.zero("qty_rolling_28d")}, ["demand_segment"], "qty_sold")
    scored = tables.through_disk(spark, scored, "scores")  # Spark does not see that the branches of the metrics score the same rows
    return rounded(scoring.error_metrics(scoring.with_total_segment(scored), ["model", "demand_segment"], few_groups=True))


@query("gbt_demand_model")
def gbt_demand_model(spark, sf):
    return fitted_demand(spark, sf, "gbt", "squared")


@query("poisson_demand_model")
def poisson_demand_model(spark, sf):
    return fitted_demand(spark, sf, "poisson", "poisson")


def new_book_model(spark, sf):
    labels = models.early_demand(fx.sales_fact(spark, sf)).withColumnRenamed("avg_daily_demand", "label")
    pairs = labels.join(fx.books_static(spark, sf), "isbn13")
    inputs = models.new_book_inputs(pairs, store_location_map(spark), locations_static(spark))
    return models.train_new_book_model(tables.through_disk(spark, inputs, "new-books"))


@query("new_book_train")
def new_book_train(spark, sf):
    model = new_book_model(spark, sf)
    trees = model.stages[-1]
    rows = [(name, float(weight)) for name, weight in zip(model.stages[-2].getInputCols(), trees.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature STRING, importance DOUBLE")


@query("new_book_forecast")
def new_book_forecast(spark, sf):
    grid = models.new_book_grid(fx.books_static(spark, sf), store_location_map(spark), locations_static(spark))
    return models.new_book_forecast(new_book_model(spark, sf), grid, store_location_map(spark), locations_static(spark))


@query(
    "new_book_quantities",
    """SELECT s.isbn13, s.store_id, CAST(l.wh_id AS BIGINT) AS wh_id, CAST(greatest(s.score, 0) AS DOUBLE) AS predicted_daily_demand,
              CAST(round(greatest(s.score, 0) * 30) AS BIGINT) AS predicted_30d_qty
       FROM (SELECT isbn13, store_id, sum(qty) % 13 / 4.0 - 0.5 AS score FROM sales_lines GROUP BY 1, 2) s
       JOIN store_location_map m ON m.store_id = s.store_id JOIN locations_static l ON l.location_id = m.inventory_location_id""",
)
def new_book_quantities(spark, sf):
    score = (F.sum("qty") % 13 / F.lit(4.0) - 0.5).alias("score")
    scores = fx.sales_lines(spark, sf).groupBy("isbn13", "store_id").agg(score)
    return models.new_book_quantities(scores, store_location_map(spark), locations_static(spark))


# Stock and orders.


@query(
    "low_stock",
    """SELECT *, on_hand - reserved_qty AS free_qty, on_hand < safety_stock AS below_safety FROM inventory
       WHERE on_hand - reserved_qty <= 5 OR on_hand < safety_stock""",
)
def low_stock(spark, sf):
    return stock.low_stock(fx.inventory(spark, sf))


@query(
    "order_state_check",
    """SELECT * FROM (SELECT order_id, status, rejection_stage, dispatched_at, executed_at,
         NOT coalesce((status IN ('IN_TRANSIT', 'EXECUTED', 'AUTO_EXECUTED')) = (dispatched_at IS NOT NULL)
             OR (status = 'REJECTED' AND rejection_stage = 'IN_TRANSIT' AND dispatched_at IS NOT NULL) OR (status = 'REJECTED' AND rejection_stage IN ('PENDING', 'APPROVED')), true) AS bad_dispatched_when,
         (status IN ('EXECUTED', 'AUTO_EXECUTED')) <> (executed_at IS NOT NULL) AS bad_executed_when,
         (status = 'REJECTED') <> (rejection_stage IS NOT NULL) AS bad_rejection_stage_when,
         NOT (rejection_stage IS NULL OR rejection_stage IN ('PENDING', 'APPROVED', 'IN_TRANSIT')) AS bad_rejection_stage_values FROM pending_orders)
       WHERE bad_dispatched_when OR bad_executed_when OR bad_rejection_stage_when OR bad_rejection_stage_values""",
)
def order_state_check(spark, sf):
    return stock.order_violations(fx.pending_orders(spark, sf))


@query(
    "order_backfill",
    """SELECT order_id, status,
         coalesce(TRY_CAST(json_extract_string(forecast_rationale, '$.expected_arrival_date') AS DATE),
           CAST(created_at AS DATE) + CASE order_type WHEN 'WH_TRANSFER' THEN 2 WHEN 'PUBLISHER_ORDER' THEN 4 ELSE 1 END) AS expected_arrival_at,
         CASE WHEN status IN ('EXECUTED', 'AUTO_EXECUTED') THEN coalesce(dispatched_at, executed_at - INTERVAL 1 HOUR, approved_at, created_at) ELSE dispatched_at END AS dispatched_at,
         CASE WHEN status = 'REJECTED' THEN CASE WHEN approved_at IS NOT NULL THEN 'APPROVED' ELSE 'PENDING' END END AS rejection_stage FROM pending_orders""",
)
def order_backfill(spark, sf):
    before = fx.pending_orders(spark, sf).withColumn("rejection_stage", F.lit(None).cast("string"))
    return stock.backfill_orders(before).select("order_id", "status", "expected_arrival_at", "dispatched_at", "rejection_stage")


@query(
    "order_classify",
    """SELECT order_id, order_type, qty, CASE order_type WHEN 'WH_TO_STORE' THEN 0 WHEN 'REBALANCE' THEN 1 WHEN 'WH_TRANSFER' THEN 2 ELSE 3 END AS cascade_stage,
              CASE order_type WHEN 'PUBLISHER_ORDER' THEN 3 ELSE 0 END AS lead_days, CASE order_type WHEN 'PUBLISHER_ORDER' THEN 24 ELSE 6 END AS est_lead_time_hours,
              qty * CASE order_type WHEN 'PUBLISHER_ORDER' THEN 15000 ELSE 500 END AS est_cost FROM pending_orders""",
)
def order_classify(spark, sf):
    return stock.classify_orders(fx.pending_orders(spark, sf).select("order_id", "order_type", "qty"))


@query(
    "inventory_snapshot_daily",
    """WITH stored AS (SELECT snapshot_date, isbn13, location_id, on_hand, reserved_qty, greatest(on_hand - reserved_qty, 0) AS available, safety_stock FROM inventory_daily),
            today AS (SELECT x.hi AS snapshot_date, isbn13, location_id, on_hand, reserved_qty, greatest(on_hand - reserved_qty, 0) AS available, safety_stock
                      FROM inventory, (SELECT max(sale_date) AS hi FROM sales_lines) x)
       SELECT * FROM stored UNION ALL SELECT * FROM today t WHERE NOT EXISTS (
         SELECT 1 FROM stored s WHERE s.snapshot_date = t.snapshot_date AND s.isbn13 = t.isbn13 AND s.location_id = t.location_id)""",
)
def inventory_snapshot_daily(spark, sf):
    day = F.col("snapshot_date")
    stored = stock.inventory_snapshot(fx.inventory_daily(spark, sf), day)
    today = stock.inventory_snapshot(fx.inventory(spark, sf), fx.newest_sale(spark, sf))
    return tables.insert_ignore(stored, today, ["snapshot_date", "isbn13", "location_id"])


@query(
    "expired_reservations",
    """SELECT isbn13, source_location_id AS location_id, count(*) AS reservation_count, CAST(sum(qty) AS BIGINT) AS reserved_qty FROM pending_orders
       WHERE status IN ('PENDING', 'APPROVED') AND created_at + INTERVAL 3 DAY < TIMESTAMP '2000-01-01' GROUP BY 1, 2""",
)
def expired_reservations(spark, sf):
    held = fx.pending_orders(spark, sf).select(
        "isbn13", F.col("source_location_id").alias("location_id"), "qty",
        F.when(F.col("status").isin("PENDING", "APPROVED"), "ACTIVE").otherwise("RELEASED").alias("status"),
        (F.col("created_at") + F.expr("INTERVAL 3 DAY")).alias("ttl"),
    )
    return stock.expired_reservations(held, F.lit("2000-01-01").cast("timestamp"))


@query(
    "open_spikes",
    """SELECT event_id, '978' || lpad(CAST(user_id AS VARCHAR), 10, '0') AS isbn13, date_trunc('second', ts) AS detected_at, CAST(NULL AS TIMESTAMP) AS resolved_at
       FROM events WHERE event_type = 'error' AND value < 20""",
)
def open_spikes(spark, sf):
    at = F.date_trunc("second", F.col("ts").cast("timestamp"))
    spikes = fx.table(spark, sf, "events").filter("event_type = 'error'").select(
        "event_id", fx.isbn("user_id").alias("isbn13"), at.alias("detected_at"), F.when(F.col("value") >= 20, at).alias("resolved_at")
    )
    return stock.open_spikes(spikes)


@query(
    "forecast_cache_sync",
    f"""WITH fresh AS (SELECT snapshot_date, isbn13, store_id, predicted_demand, model_version FROM ({SLICE_SQL})),
             cached AS (SELECT target_date AS snapshot_date, isbn13, store_id, predicted_demand, model_version FROM forecast_results
                        WHERE prediction_date < (SELECT max(prediction_date) FROM forecast_results))
        SELECT * FROM fresh UNION ALL SELECT * FROM cached c WHERE NOT EXISTS (
          SELECT 1 FROM fresh f WHERE f.snapshot_date = c.snapshot_date AND f.isbn13 = c.isbn13 AND f.store_id = c.store_id)""",
)
def forecast_cache_sync(spark, sf):
    rows = fx.forecast_results(spark, sf)
    newest = fx.newest_sale(spark, sf)
    fresh = policy.latest_run_slice(rows, 2).select("snapshot_date", "isbn13", "store_id", "predicted_demand", "model_version")
    cached = rows.filter(F.col("prediction_date") < newest).select(F.col("target_date").alias("snapshot_date"), "isbn13", "store_id", "predicted_demand", "model_version")
    return tables.upsert(cached, fresh, ["snapshot_date", "isbn13", "store_id"])
