"""Stock rules and order state rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.domain import ORDER_TYPES
from shelfcast.functions.columns import case_map


def low_stock(inventory: DataFrame, limit: int = 5) -> DataFrame:
    """Free stock at or below the limit, or on-hand stock below its safety level."""
    free = F.col("on_hand") - F.col("reserved_qty")
    return inventory.withColumn("free_qty", free).withColumn("below_safety", F.col("on_hand") < F.col("safety_stock")).filter(
        (F.col("free_qty") <= limit) | F.col("below_safety")
    )


def inventory_snapshot(inventory: DataFrame, run_date: Column) -> DataFrame:
    """Current stock as the snapshot of the run date."""
    free = F.greatest(F.col("on_hand") - F.col("reserved_qty"), F.lit(0))
    return inventory.select(run_date.alias("snapshot_date"), "isbn13", "location_id", "on_hand", "reserved_qty", free.alias("available"), "safety_stock")


def expired_reservations(reservations: DataFrame, run_ts: Column) -> DataFrame:
    """Reserved units per book and place whose active reservation has run out."""
    return (
        reservations.filter((F.col("status") == "ACTIVE") & (F.col("ttl") < run_ts))
        .groupBy("isbn13", "location_id")
        .agg(F.count("*").alias("reservation_count"), F.sum("qty").alias("reserved_qty"))
    )


def open_spikes(spikes: DataFrame) -> DataFrame:
    return spikes.filter(F.col("resolved_at").isNull()).orderBy(F.desc("detected_at"), "isbn13")


def order_violations(orders: DataFrame) -> DataFrame:
    """Orders that break one of the four state rules; a rule that is NULL holds."""
    status, stage = F.col("status"), F.col("rejection_stage")
    done = status.isin("EXECUTED", "AUTO_EXECUTED")
    sent = F.col("dispatched_at").isNotNull()
    refused = status == "REJECTED"
    rules = {
        "dispatched_when": ((done | (status == "IN_TRANSIT")) == sent)
        | (refused & (stage == "IN_TRANSIT") & sent)
        | (refused & stage.isin("PENDING", "APPROVED")),
        "executed_when": done == F.col("executed_at").isNotNull(),
        "rejection_stage_when": refused == stage.isNotNull(),
        "rejection_stage_values": stage.isNull() | stage.isin("PENDING", "APPROVED", "IN_TRANSIT"),
    }
    flags = {f"bad_{name}": ~F.coalesce(rule, F.lit(True)) for name, rule in rules.items()}
    broken = F.lit(False)
    for flag in flags:
        broken = broken | F.col(flag)
    return orders.select("order_id", "status", "rejection_stage", "dispatched_at", "executed_at").withColumns(flags).filter(broken)


def backfill_orders(orders: DataFrame) -> DataFrame:
    """Arrival date from the plan text or lead days, and missing stage columns."""
    planned = F.get_json_object("forecast_rationale", "$.expected_arrival_date").try_cast("date")
    lead = case_map("order_type", {k: v[1] for k, v in ORDER_TYPES.items()}, 1)
    guess = F.date_add(F.to_date("created_at"), lead)
    done = F.col("status").isin("EXECUTED", "AUTO_EXECUTED")
    sent = F.coalesce(F.col("executed_at") - F.expr("INTERVAL 1 HOUR"), F.col("approved_at"), F.col("created_at"))
    stage = F.when(F.col("approved_at").isNotNull(), "APPROVED").otherwise("PENDING")
    return orders.withColumns(
        {
            "expected_arrival_at": F.coalesce(planned, guess),
            "dispatched_at": F.when(F.col("dispatched_at").isNull() & done, sent).otherwise(F.col("dispatched_at")),
            "rejection_stage": F.when(F.col("rejection_stage").isNull() & (F.col("status") == "REJECTED"), stage).otherwise(
                F.col("rejection_stage")
            ),
        }
    )


def classify_orders(orders: DataFrame) -> DataFrame:
    """Cascade stage, planned lead days, lead hours and estimated cost by order type."""
    outside = F.col("order_type") == "PUBLISHER_ORDER"
    return orders.withColumns(
        {
            "cascade_stage": case_map("order_type", {k: v[0] for k, v in ORDER_TYPES.items()}, None),
            "lead_days": case_map("order_type", {k: v[2] for k, v in ORDER_TYPES.items()}, 0),
            "est_lead_time_hours": F.when(outside, 24).otherwise(6),
            "est_cost": F.col("qty") * F.when(outside, 15_000).otherwise(500),
        }
    )
