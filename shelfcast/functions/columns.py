"""Column expressions: validation, bands, dates, hashes and null rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_isbn13(c) -> Column:
    """Thirteen digits; NULL is not valid."""
    return F.coalesce(col(c).rlike(r"^\d{13}$"), F.lit(False))


def isbn13_check_digit(first12) -> Column:
    """Weighted 1,3,1,3.. sum over twelve digits, as a mod-10 complement."""
    text = col(first12)
    terms = [F.substring(text, i + 1, 1).try_cast("int") * (1 if i % 2 == 0 else 3) for i in range(12)]
    return (F.lit(10) - reduce(lambda a, b: a + b, terms) % 10) % 10


def isbn13_checksum_ok(c) -> Column:
    text = col(c)
    last = F.substring(text, 13, 1).try_cast("int")
    return F.when(is_isbn13(text), isbn13_check_digit(text) == last).otherwise(F.lit(False))


def price_tier(price, low: int = 10_000, high: int = 20_000) -> Column:
    """LOW below ``low``, MID below ``high``, else HIGH; two band pairs are in use."""
    p = col(price)
    return F.when(p < low, "LOW").when(p < high, "MID").otherwise("HIGH")


def season(month) -> Column:
    m = col(month)
    return (
        F.when(m.between(3, 5), "SPRING")
        .when(m.between(6, 8), "SUMMER")
        .when(m.between(9, 11), "FALL")
        .otherwise("WINTER")
    )


def weekday(c) -> Column:
    """1 = Sunday .. 7 = Saturday, the one convention used throughout."""
    return F.dayofweek(col(c)).cast("bigint")


def is_weekend(c) -> Column:
    return F.dayofweek(col(c)).isin(1, 7)


def weekday_of_date(c) -> Column:
    """``weekday`` of a date from its day number, cheaper where billions of dates are made; 1970-01-04 is a Sunday."""
    return (F.pmod(F.datediff(col(c), F.lit("1970-01-04").cast("date")), F.lit(7)) + 1).cast("bigint")


def iso_weekday_to_sunday_first(c) -> Column:
    """1 = Monday .. 7 = Sunday into 1 = Sunday .. 7 = Saturday."""
    return col(c) % 7 + 1


def strict_greatest(*cols) -> Column:
    """``greatest`` that is NULL when any argument is NULL."""
    values = [col(c) for c in cols]
    present = reduce(lambda a, b: a & b, [v.isNotNull() for v in values])
    return F.when(present, F.greatest(*values))


def safe_ratio(num, den) -> Column:
    """NULL instead of an error when the denominator is zero."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def int_div(num, den) -> Column:
    """Truncating integer division, NULL over zero."""
    n, d = col(num), col(den)
    return F.when(d != 0, F.call_function("div", n, d))


def hash_bucket(key, buckets: int = 100) -> Column:
    """Stable bucket number from the first eight hex digits of md5."""
    head = F.substring(F.md5(col(key)), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") % buckets


def hash_unit(key) -> Column:
    """Stable number in [0, 1] from the first twelve hex digits of SHA-256."""
    head = F.substring(F.sha2(col(key), 256), 1, 12)
    return F.conv(head, 16, 10).cast("double") / F.lit(float(16**12 - 1))


def first_author(c) -> Column:
    """Text before the first comma, then before the first semicolon."""
    before_comma = F.trim(F.split(F.coalesce(col(c), F.lit("")), ",").getItem(0))
    head = F.trim(F.split(before_comma, ";").getItem(0))
    return F.when(head == "", "(unknown)").otherwise(head)


def strip_html(c) -> Column:
    return F.trim(F.regexp_replace(col(c), "<[^>]+>", ""))


def business_date(ts, zone: str = "Asia/Seoul") -> Column:
    """Calendar date of a UTC timestamp in the business time zone."""
    return F.to_date(F.from_utc_timestamp(col(ts), zone))


def case_map(c, mapping: dict, default=None) -> Column:
    """CASE over a small fixed mapping; stays inside generated code, no join."""
    source = col(c)
    out = None
    for key, value in mapping.items():
        out = F.when(source == key, F.lit(value)) if out is None else out.when(source == key, F.lit(value))
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def reasons(*flag_and_text) -> Column:
    """``;``-joined texts of the flags that are true; an empty text if none is."""
    parts = [F.when(flag, F.lit(text)) for flag, text in flag_and_text]
    return F.concat_ws(";", *parts)
