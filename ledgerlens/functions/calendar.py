"""Business-day calendar dimension (F43-F46 support).

One row per date over a span: weekday, holiday flag, business flag and the
business ordinal (business days up to and including the date).  The table
is bounded by the number of days in the span (tens of thousands at most),
so joins against it are broadcast; every business-day shift becomes an
equi-join on the ordinal instead of a while-loop.

Holidays: Brazilian national holidays — fixed dates plus Good Friday, whose
date follows from Easter (anonymous Gregorian computus, integer column
arithmetic).  Callers may pass their own holiday table instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# National fixed-date holidays (month, day) and, since 2024,
# 20 November.
FIXED_HOLIDAYS = [(1, 1), (4, 21), (5, 1), (9, 7), (10, 12), (11, 2), (11, 15), (12, 25)]
FIXED_HOLIDAYS_SINCE_2024 = [(11, 20)]

# Weekday index as Python's ``weekday()``: Monday 0 .. Sunday 6.
WEEKDAY_PT = ["segunda", "terça", "quarta", "quinta", "sexta", "sabado", "domingo"]


def py_weekday(d: Column) -> Column:
    """Monday 0 .. Sunday 6 (Spark ``weekday`` already follows this)."""
    return F.weekday(d)


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter Sunday of ``year`` (integer arithmetic only)."""
    y = year
    a = F.pmod(y, F.lit(19))
    b = F.floor(y / 100)
    c = F.pmod(y, F.lit(100))
    d = F.floor(b / 4)
    e = F.pmod(b, F.lit(4))
    f = F.floor((b + 8) / 25)
    g = F.floor((b - f + 1) / 3)
    h = F.pmod(19 * a + b - d - g + 15, F.lit(30))
    i = F.floor(c / 4)
    k = F.pmod(c, F.lit(4))
    ll = F.pmod(32 + 2 * e + 2 * i - h - k, F.lit(7))
    m = F.floor((a + 11 * h + 22 * ll) / 451)
    month = F.floor((h + ll - 7 * m + 114) / 31)
    day = F.pmod(h + ll - 7 * m + 114, F.lit(31)) + 1
    return F.make_date(y.cast("int"), month.cast("int"), day.cast("int"))


def holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """National holidays for ``[first_year, last_year]`` as (data)."""
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("ano"))
    fixed = [F.make_date(F.col("ano"), F.lit(m), F.lit(d)) for m, d in FIXED_HOLIDAYS]
    recent = [F.when(F.col("ano") >= 2024, F.make_date(F.col("ano"), F.lit(m), F.lit(d)))
              for m, d in FIXED_HOLIDAYS_SINCE_2024]
    good_friday = F.date_sub(easter_sunday(F.col("ano")), 2)
    days = years.select(F.explode(F.array(*fixed, *recent, good_friday)).alias("data"))
    return days.filter(F.col("data").isNotNull()).distinct()


def calendar(spark: SparkSession, start: str, end: str, holiday_table: DataFrame | None = None) -> DataFrame:
    """Calendar rows for every date in ``[start, end]`` (literal span)."""
    span = spark.range(1).select(F.lit(start).cast("date").alias("_lo"), F.lit(end).cast("date").alias("_hi"))
    return calendar_for_span(span, 0, holiday_table)


def calendar_for_span(span: DataFrame, margin_days: int = 0, holiday_table: DataFrame | None = None) -> DataFrame:
    """Calendar rows for every date between the ``_lo`` and ``_hi`` columns
    of a one-row ``span`` frame (plus ``margin_days``), built inside Spark
    (no driver round trip).

    ``ordinal`` counts business days up to and including the date; it is a
    running count over a table with one row per day (bounded, so its
    single ordered window is cheap)."""
    days = span.select(F.explode(F.sequence(F.col("_lo"), F.date_add(F.col("_hi"), margin_days))).alias("data"))
    if holiday_table is None:
        years = days.select(F.year("data").alias("ano")).distinct()
        fixed = [F.make_date(F.col("ano"), F.lit(m), F.lit(d)) for m, d in FIXED_HOLIDAYS]
        recent = [F.when(F.col("ano") >= 2024, F.make_date(F.col("ano"), F.lit(m), F.lit(d)))
                  for m, d in FIXED_HOLIDAYS_SINCE_2024]
        good_friday = F.date_sub(easter_sunday(F.col("ano")), 2)
        holiday_table = (years.select(F.explode(F.array(*fixed, *recent, good_friday)).alias("data"))
                         .filter(F.col("data").isNotNull()).distinct())
    hol = holiday_table.select("data", F.lit(True).alias("feriado"))
    cal = days.join(F.broadcast(hol), "data", "left").withColumn("feriado", F.coalesce("feriado", F.lit(False)))
    cal = cal.withColumn("dia_semana", py_weekday(F.col("data")))
    cal = cal.withColumn("util", (F.col("dia_semana") < 5) & ~F.col("feriado"))
    w = Window.orderBy("data").rowsBetween(Window.unboundedPreceding, 0)
    return cal.withColumn("ordinal", F.sum(F.col("util").cast("long")).over(w))
