"""Fixed business values and the two inline dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The sixteen locations
# (location_id, location_type, wh_id, name, size, region, is_virtual, active).
LOCATIONS = [
    (1, "STORE_OFFLINE", 1, "강남점", "L", "수도권", False, True),
    (2, "STORE_OFFLINE", 1, "광화문점", "L", "수도권", False, True),
    (3, "STORE_OFFLINE", 1, "잠실점", "M", "수도권", False, True),
    (4, "STORE_OFFLINE", 1, "홍대점", "M", "수도권", False, True),
    (5, "STORE_OFFLINE", 1, "신촌점", "S", "수도권", False, True),
    (6, "STORE_OFFLINE", 1, "용산점", "S", "수도권", False, True),
    (7, "STORE_OFFLINE", 2, "부산 서면점", "L", "영남", False, True),
    (8, "STORE_OFFLINE", 2, "대구 동성점", "L", "영남", False, True),
    (9, "STORE_OFFLINE", 2, "울산 삼산점", "M", "영남", False, True),
    (10, "STORE_OFFLINE", 2, "대구 교대점", "M", "영남", False, True),
    (11, "STORE_OFFLINE", 2, "부산 센텀점", "S", "영남", False, True),
    (12, "STORE_OFFLINE", 2, "포항 양덕점", "S", "영남", False, True),
    (13, "STORE_ONLINE", 1, "수도권 온라인", "L", "수도권", True, True),
    (14, "STORE_ONLINE", 2, "영남 온라인", "L", "영남", True, True),
    (15, "WH", 1, "수도권 거점창고", "XL", "수도권", False, True),
    (16, "WH", 2, "영남 거점창고", "XL", "영남", False, True),
]

# Public holidays with a fixed solar date (month, day, name).
HOLIDAYS = [
    (1, 1, "신정"),
    (3, 1, "삼일절"),
    (5, 5, "어린이날"),
    (6, 6, "현충일"),
    (8, 15, "광복절"),
    (10, 3, "개천절"),
    (10, 9, "한글날"),
    (12, 25, "크리스마스"),
]

# Yearly trade events (event_type, month, first day, days).
YEARLY_EVENTS = [
    ("book_fair", 2, 1, 5),
    ("book_fair", 6, 1, 5),
    ("book_fair", 9, 1, 4),
    ("book_fair", 10, 1, 6),
    ("book_fair", 11, 1, 3),
    ("publisher_promo", 3, 1, 30),
    ("publisher_promo", 6, 1, 30),
    ("publisher_promo", 9, 1, 30),
    ("publisher_promo", 12, 1, 30),
    ("author_signing", 4, 15, 1),
    ("author_signing", 7, 15, 1),
    ("author_signing", 10, 15, 1),
]

# Calendar feed types, in reading order.
EVENT_TYPES = ["book_fair", "holiday", "publisher_promo", "author_signing"]

# Mart folder to warehouse table. The calendar folder has its own
# table here, because its columns are not those of the feature table.
MART_TABLES = {
    "pos_events": "sales_fact",
    "sales_daily": "sales_fact",
    "aladin_books": "books_static",
    "books_static": "books_static",
    "calendar_events": "calendar_events",
    "features": "features",
    "inventory_daily": "inventory_daily",
    "locations_static": "locations_static",
    "store_location_map": "store_location_map",
    "sns_mentions": "sns_mentions",
}

# Old to new store ids, and old to new inventory location ids.
STORE_REMAP = {1: 1, 2: 4, 3: 3, 4: 5, 5: 6, 6: 13, 7: 7, 8: 9, 9: 10, 10: 11, 11: 12, 12: 14}
STORE_REMAP_WH = {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 2, 8: 2, 9: 2, 10: 2, 11: 2, 12: 2, 13: 1, 14: 2}
LOCATION_REMAP = {3: 1, 4: 4, 5: 3, 6: 5, 7: 6, 9: 7, 10: 9, 11: 10, 12: 11, 13: 12}
# New stores opened as copies of an old one: (new id, warehouse, old store, old location).
STORE_CLONES = [(2, 1, 1, 3), (8, 2, 7, 9)]

# Store to warehouse map of the first stream consumer.
STREAM_STORE_WH = {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 2, 7: 2, 8: 2, 9: 2, 10: 2, 11: 1, 12: 1}

# Order type to (cascade stage, backfill lead days, planned lead days).
ORDER_TYPES = {
    "WH_TO_STORE": (0, 1, 0),
    "REBALANCE": (1, 1, 0),
    "WH_TRANSFER": (2, 2, 0),
    "PUBLISHER_ORDER": (3, 4, 3),
}

# Smallest acceptable row counts after a load.
MIN_ROWS = {
    "books": 1000,
    "authors": 100,
    "publishers": 30,
    "warehouses": 2,
    "locations": 12,
    "inventory": 1000,
    "forecast_cache": 100,
    "pending_orders": 10,
}

# Model inputs, in training order.
NUMERIC_FEATURES = [
    "store_id", "wh_id", "on_hand", "reserved_qty", "safety_stock", "holiday_flag", "day_of_week", "month",
    "weekend_flag", "event_nearby_days", "sns_mentions_1d", "sns_mentions_7d", "book_age_days",
    "days_since_last_stockout", "category_id", "sales_point", "bestseller_flag", "author_experience_years",
    "qty_lag_1", "qty_lag_7", "qty_rolling_7d", "qty_rolling_28d",
]
CATEGORICAL_FEATURES = ["channel", "location_type", "store_size", "region", "price_tier", "demand_segment"]


def sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def values_sql(rows, columns) -> str:
    """``SELECT .. FROM VALUES`` text that both Spark and other engines read."""
    body = ", ".join("(" + ", ".join(sql_literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(columns)})"


LOCATION_COLUMNS = ["location_id", "location_type", "wh_id", "name", "size", "region", "is_virtual", "active"]
STORE_MAP_COLUMNS = ["store_id", "location_id", "inventory_location_id", "mapping_rule"]


def store_map_rows():
    """Physical stores hold their own stock; online stores draw on their warehouse."""
    warehouse = {wh: loc for loc, kind, wh, *_ in LOCATIONS if kind == "WH"}
    rows = []
    for loc, kind, wh, *_ in LOCATIONS:
        if kind == "WH":
            continue
        stock = warehouse[wh] if kind == "STORE_ONLINE" else loc
        rows.append((loc, loc, stock, f"{loc}->{loc}->{stock}"))
    return rows


def inline_table(spark: SparkSession, rows, columns) -> DataFrame:
    """A constant table. Its size is part of the plan, so joins see that it is tiny."""
    return spark.sql(values_sql(rows, columns))


def locations_static(spark: SparkSession) -> DataFrame:
    return inline_table(spark, LOCATIONS, LOCATION_COLUMNS)


def store_location_map(spark: SparkSession) -> DataFrame:
    return inline_table(spark, store_map_rows(), STORE_MAP_COLUMNS)
