"""Date and time scalars (F33-F47) as Column -> Column functions.

Reference time enters only as an ``as_of`` argument (a string literal or a
Column); no function reads the wall clock.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the first Monday of 1970, origin of the weekday arithmetic.
_MONDAY_ORIGIN = "1970-01-05"


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ts_ntz(value) -> Column:
    """TIMESTAMP_NTZ literal (driver tables are NTZ; no session time zone)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, (_dt.datetime, _dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
    return F.to_timestamp_ntz(F.lit(str(value)))


def date_lit(value) -> Column:
    if isinstance(value, Column):
        return value
    return F.to_date(F.lit(str(value)))


def month_label(c) -> Column:
    """``DATE_FORMAT(d, '%Y-%m')``."""
    return F.date_format(c, "yyyy-MM")


def _micros_of_day(ts: Column) -> Column:
    """Microsecond of the day from the wall-clock fields (no time zone)."""
    return (((F.hour(ts) * 60 + F.minute(ts)) * 60 + F.second(ts)).cast("long") * 1_000_000
            + F.date_format(ts, "SSSSSS").cast("long"))


def _months_forward(a: Column, b: Column) -> Column:
    calendar = (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
    earlier = ((F.dayofmonth(b) < F.dayofmonth(a))
               | ((F.dayofmonth(b) == F.dayofmonth(a)) & (_micros_of_day(b) < _micros_of_day(a))))
    return calendar - F.when(earlier, 1).otherwise(0)


def complete_months(start, end) -> Column:
    """complete months between two timestamps (TIMESTAMPDIFF(MONTH)).

    Not ``months_between``: Jan 31 -> Feb 29 is 0 complete months (trap T1).
    Computed from the calendar fields, so a session time zone with a DST
    gap cannot shift a wall-clock timestamp (Spark's ``timestamp_diff``
    converts NTZ values through the session zone).  Negative spans truncate
    toward zero, as MySQL does.
    """
    a, b = _col(start), _col(end)
    return F.when(b >= a, _months_forward(a, b)).otherwise(-_months_forward(b, a)).cast("long")


def wall_micros(ts) -> Column:
    """Microseconds of wall-clock time since 1970, of a date or timestamp."""
    t = F.col(ts) if isinstance(ts, str) else ts
    t = t.cast("timestamp_ntz")
    return F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000_000 + _micros_of_day(t)


def elapsed_seconds(end, start) -> Column:
    """Elapsed seconds between two wall-clock timestamps (fractions floored),
    independent of the session time zone."""
    e, s = _col(end), _col(start)
    micros = (F.datediff(F.to_date(e), F.to_date(s)).cast("long") * 86_400_000_000
              + _micros_of_day(e) - _micros_of_day(s))
    return F.floor(micros / F.lit(1_000_000)).cast("long")


def day_diff(end, start) -> Column:
    """``DATEDIFF(end, start)`` on calendar dates."""
    return F.datediff(end, start)


def elapsed_days(end, start) -> Column:
    """F35 (elapsed form): floor of the elapsed duration in days (computed
    on the timestamps themselves, no session time zone involved)."""
    return F.floor(elapsed_seconds(end, start) / F.lit(86400)).cast("long")


def parse_day_first(c) -> Column:
    """day-first date text (``5/3/2024`` or ``05/03/2024``), bad -> NULL."""
    return F.try_to_date(c if not isinstance(c, str) else F.col(c), "d/M/yyyy")


def tolerant_timestamp(c) -> Column:
    """tolerant timestamp parse, bad -> NULL."""
    return F.try_to_timestamp(c)


def format_br_date(c) -> Column:
    """date -> ``dd/MM/yyyy`` text, NULL kept."""
    return F.date_format(c, "dd/MM/yyyy")


def age_years(birth, as_of) -> Column:
    """whole years of age, NULL outside 18..99."""
    birth = F.to_date(birth)
    as_of = F.to_date(as_of)
    years = (F.year(as_of) - F.year(birth)
             - F.when((F.month(as_of) < F.month(birth))
                      | ((F.month(as_of) == F.month(birth)) & (F.dayofmonth(as_of) < F.dayofmonth(birth))), 1)
             .otherwise(0))
    return F.when(years.between(18, 99), years.cast("int"))


def age_by_days(birth, as_of) -> Column:
    """``floor(days / 365.25)``."""
    return F.floor(F.datediff(F.to_date(as_of), F.to_date(birth)) / F.lit(365.25)).cast("int")


def weekday_ordinal(d) -> Column:
    """Business days (Mon-Fri) from the origin Monday up to, excluding, ``d``."""
    n = F.datediff(F.to_date(d), F.lit(_MONDAY_ORIGIN))
    return (F.lit(5) * F.floor(n / 7) + F.least(F.pmod(n, F.lit(7)), F.lit(5))).cast("long")


def business_days_between(start, end) -> Column:
    """weekday count in ``[start, end)`` (numpy ``busday_count``, no holidays).

    Closed form, so it stays inside whole-stage codegen: w(end) - w(start).
    """
    return weekday_ordinal(end) - weekday_ordinal(start)


def minus_business_days(d, n: int) -> Column:
    """``d - BDay(n)`` for weekday counting (no holidays).

    Rolls a weekend ``d`` back to Friday first (pandas BDay semantics for
    subtraction from a non-business day count the roll as the first step).
    """
    d = F.to_date(d)
    dow = F.dayofweek(d)  # 1 = Sunday .. 7 = Saturday
    # pandas: subtracting BDay from a weekend first rolls to the previous
    # business day, which counts as one step.
    rolled = F.when(dow == 1, F.date_sub(d, 2)).when(dow == 7, F.date_sub(d, 1)).otherwise(d)
    steps = F.when(dow.isin(1, 7), F.lit(n - 1)).otherwise(F.lit(n))
    # weekday ordinal of rolled minus steps, back to a date
    w = weekday_ordinal(rolled) - steps
    weeks = F.floor(w / 5)
    rem = F.pmod(w, F.lit(5))
    return F.date_add(F.lit(_MONDAY_ORIGIN).cast("date"), (weeks * 7 + rem).cast("int"))


def months_index(d, ref_year: int, ref_month: int) -> Column:
    """months elapsed from ``d`` to a reference month, 1-based."""
    return ((F.lit(ref_year) - F.year(d)) * 12 + F.lit(ref_month) - F.month(d) + 1).cast("long")


def monthly_cutoff(d, limit_day: int) -> Column:
    """monthly cut-off: the limit day of this month, or of next month
    when ``d`` is past the limit day.  A month without that day ends the
    period on its last day."""
    d = F.to_date(d)
    month_start = F.trunc(d, "MM")
    target = F.when(F.dayofmonth(d) > limit_day, F.add_months(month_start, 1)).otherwise(month_start)
    day = F.least(F.lit(limit_day) if isinstance(limit_day, int) else limit_day, F.dayofmonth(F.last_day(target)))
    return F.make_date(F.year(target), F.month(target), day)
