from pyspark.sql import functions as F

from shelfcast.functions import columns as fn


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_isbn_rules(spark):
    assert one(spark, fn.is_isbn13(F.lit("9780306406157")))
    assert not one(spark, fn.is_isbn13(F.lit("978030640615X")))
    assert one(spark, fn.is_isbn13(F.lit(None).cast("string"))) is False
    assert one(spark, fn.isbn13_check_digit(F.lit("9780306406157"))) == 7
    assert one(spark, fn.isbn13_checksum_ok(F.lit("9780306406157")))
    assert not one(spark, fn.isbn13_checksum_ok(F.lit("9780306406158")))


def test_price_bands_differ(spark):
    assert one(spark, fn.price_tier(F.lit(12_000))) == "MID"
    assert one(spark, fn.price_tier(F.lit(12_000), 15_000, 26_000)) == "LOW"


def test_greatest_with_null_is_null(spark):
    assert one(spark, fn.strict_greatest(F.lit(None).cast("int"), F.lit(0))) is None
    assert one(spark, F.greatest(F.lit(None).cast("int"), F.lit(0))) == 0


def test_integer_division_and_ratio(spark):
    assert one(spark, fn.int_div(F.lit(7), F.lit(2))) == 3
    assert one(spark, fn.int_div(F.lit(7), F.lit(0))) is None
    assert one(spark, fn.safe_ratio(F.lit(7), F.lit(0))) is None


def test_rounding_modes(spark):
    assert one(spark, F.round(F.lit(2.5))) == 3.0
    assert one(spark, F.bround(F.lit(2.5))) == 2.0


def test_weekday_conventions(spark):
    sunday = F.lit("2024-01-07").cast("date")
    assert one(spark, fn.weekday(sunday)) == 1
    assert one(spark, fn.iso_weekday_to_sunday_first(F.lit(7))) == 1
    assert one(spark, fn.iso_weekday_to_sunday_first(F.lit(1))) == 2


def test_business_date_is_local(spark):
    late = F.lit("2024-01-01 16:00:00").cast("timestamp")
    assert str(one(spark, fn.business_date(late))) == "2024-01-02"


def test_first_author(spark):
    assert one(spark, fn.first_author(F.lit("Kim; Lee, Park"))) == "Kim"
    assert one(spark, fn.first_author(F.lit(None).cast("string"))) == "(unknown)"


def test_reasons(spark):
    yes, no = F.lit(True), F.lit(False)
    assert one(spark, fn.reasons((yes, "a"), (no, "b"), (yes, "c"))) == "a;c"
    assert one(spark, fn.reasons((no, "b"))) == ""


def test_hash_unit_range(spark):
    r = spark.range(500).select(fn.hash_unit(F.col("id").cast("string")).alias("u")).agg(F.min("u"), F.max("u")).first()
    assert 0 <= r[0] < 0.05 and 0.95 < r[1] <= 1
