"""Date and time functions. Under ANSI mode a bad value raises, so every parse here is
a ``try_`` variant that yields NULL instead (``errors="coerce"``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framewise.functions.text import pad_left, strip_trailing_zero_decimal


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hhmm_to_timestamp(date, hhmm) -> Column:
    """Flight-style times: "914.0" / "5" / "2400" -> date + HH:MM. Text is cleaned of
    ``.0``, left-padded to 4 digits, split, and put together with coercion, so "2400" and
    longer junk give NULL. No time zone takes part."""
    t = pad_left(strip_trailing_zero_decimal(hhmm), 4)
    day, number = _c(date).cast("string").try_cast("date"), F.when(t.rlike("^[0-9]{4}$"), t)
    return F.try_make_timestamp_ntz(F.year(day), F.month(day), F.day(day), F.substring(number, 1, 2).cast("int"),
                                    F.substring(number, 3, 2).cast("int"), F.lit(0).cast("decimal(16,6)"))


def parse_date_weekday(text, fmt: str = "MMM d, yyyy") -> Column:
    """``to_datetime(format="%a, %b %d, %Y")``: Spark cannot parse a weekday name, so the
    leading "Tue, " is removed first."""
    stripped = F.regexp_replace(_c(text), r"^[A-Za-z]{3},\s*", "")
    return F.try_to_timestamp(stripped, F.lit(fmt)).cast("timestamp_ntz")


def to_number(x) -> Column:
    """``to_numeric(errors="coerce")``."""
    return _c(x).try_cast("double")


# The units of a duration and their microseconds.
DURATION_UNITS = [
    (("weeks", "week", "w"), 604_800_000_000), (("days", "day", "d"), 86_400_000_000),
    (("hours", "hour", "hrs", "hr", "h"), 3_600_000_000), (("minutes", "minute", "mins", "min", "m"), 60_000_000),
    (("seconds", "second", "secs", "sec", "s"), 1_000_000),
    (("milliseconds", "millisecond", "millis", "milli", "ms"), 1_000), (("microseconds", "microsecond", "micros", "micro", "us"), 1)]


MARK = "\x01"   # between the fields of a duration; a text that has it is none


def to_timedelta(text) -> Column:
    """``to_timedelta(errors="coerce")`` of text: numbers with units (``1 day 2.5 hours``, ``3d4h``, ``-2 weeks``), a clock
    (``6:05``, ``30:00:01.5``), or days and a clock (``1 days 06:00:00``), as a day-time interval.

    A sign in front counts for all numbers with units, or for a clock alone; a clock behind units has its own sign or none
    (``-1 days +06:00:00`` and ``-1 days 06:00:00`` are 18 hours back, as in pandas 2.3). Case and white space don't
    matter. NULL for NULL, anything else (a number without a unit too), and durations beyond 10^12 seconds. Below a
    microsecond digits are rounded."""
    names = sorted((n for unit, _ in DURATION_UNITS for n in unit), key=len, reverse=True)
    part = rf"\d++(?:\.\d++)?\s*+(?:{'|'.join(names)})(?![a-z])[\s,]*+"
    clock = r"([+-]?)\s*+(\d++):([0-5]?\d)(?::([0-5]?\d(?:\.\d++)?))?"
    # One match takes the text apart, into fields between marks; what doesn't match stays as it is and has one field at most.
    whole = rf"^(?=\D*+\d)\s*+([+-]?)\s*+((?:{part})*+)(?:{clock})?[\x85\u2028\u2029]?+\s*+\z"
    text = F.lower(_c(text))
    fields = F.split(F.when(~F.contains(text, F.lit(MARK)), F.regexp_replace(text, whole, MARK.join(["", *[f"${i}" for i in range(1, 7)], ""]))), MARK)
    micros = F.create_map(*[F.lit(x) for unit, us in DURATION_UNITS for n in unit for x in (n, us)])

    def interval(found: Column) -> Column:
        lead, units, own, *times = [F.get(found, F.lit(i)) for i in range(1, 7)]
        amounts = F.regexp_extract_all(units, F.lit(r"[0-9.]+"), F.lit(0)), F.regexp_extract_all(units, F.lit("[a-z]+"), F.lit(0))
        of_units = F.aggregate(F.arrays_zip(amounts[0].alias("n"), amounts[1].alias("u")), F.lit(0).cast("decimal(38,6)"),
                               lambda acc, p: (acc + p["n"].try_cast("decimal(24,9)") * micros[p["u"]]).cast("decimal(38,6)"))
        hour, minute, second = [F.coalesce(t.try_cast("decimal(20,9)"), F.lit(0)) for t in times]
        of_clock = F.when(times[0] == "", F.lit(0)).otherwise(hour * 3_600_000_000 + minute * 60_000_000 + second * 1_000_000)
        sign = F.when(lead == "-", -1).otherwise(1)
        clock_sign = F.when((own == "") & (units == ""), sign).otherwise(F.when(own == "-", -1).otherwise(1))
        seconds = ((sign * of_units + clock_sign * of_clock) / 1_000_000).try_cast("decimal(18,6)")
        return F.when(F.size(found) > 1, F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds))
    # A function of an element: the fields are found once, however often they are named.
    return F.transform(F.array(fields), interval)[0]


def micros_of(interval) -> Column:
    """A day-time interval as whole microseconds."""
    return (_c(interval).cast("decimal(18,6)") * 1_000_000).cast("bigint")


def add_offset(ts, months: int = 0, days: int = 0) -> Column:
    """``+ DateOffset(months=m, days=d)``: months first (day clamped to month end), then days."""
    c = _c(ts)
    return c + F.make_interval(F.lit(0), F.lit(months), F.lit(0), F.lit(days))


def localize_to_utc(ts, tz: str) -> Column:
    """``tz_localize(tz).tz_convert("UTC")`` for a wall-clock timestamp; the answer is the
    UTC wall clock (timestamp_ntz), independent of the session time zone. A wall-clock
    time that occurs twice (DST end) resolves to the earlier instant; one that does not
    exist (DST start) moves forward by the gap."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), _c(ts).cast("timestamp_ntz"))


def whole_days_between(start, end) -> Column:
    """``(end - start).dt.days``: floor of the elapsed 24-hour periods (no time zone)."""
    us = F.timestamp_diff("MICROSECOND", _c(start), _c(end))
    return F.floor(us / F.lit(86_400_000_000)).cast("bigint")


def nth_weekday_of_month(year, month: int, weekday: str, n: int) -> Column:
    """Date of the n-th ``weekday`` ("MON") of a month, e.g. Columbus Day (2nd Monday of
    October) = nth_weekday_of_month(year, 10, "MON", 2)."""
    first = F.make_date(_c(year), F.lit(month), F.lit(1))
    return F.date_add(F.next_day(F.date_sub(first, 1), weekday), 7 * (n - 1))
