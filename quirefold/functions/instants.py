"""Event-time text and epoch seconds to instants, and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# the form that nearly all events have; it is read by a cast
USUAL = r"^(?!0000)\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}(:?\d{2})?)?\z"

# all forms: calendar and week dates, extended or basic; any separator; time to the hour, minute, second
# or a fraction of any length after a point or comma; offset alike. Year 0 does not exist.
_CLOCK = r"(\d\d)(?::(\d\d)(?::(\d\d)(?:[.,](\d+))?)?|(\d\d)(?:(\d\d)(?:[.,](\d+))?)?)?"
ANY_FORM = (
    r"^(?!0000)(\d{4})(?:-(\d\d)-(\d\d)|(\d\d)(\d\d)|-W(\d\d)(?:-(\d))?|W(\d\d)(\d)?)"
    rf"(?:[^Z]{_CLOCK}(?:Z|([+-]){_CLOCK})?)?\z"
)
# groups of ANY_FORM
YEAR, MONTH, DAY, BASIC_MONTH, BASIC_DAY, WEEK, WEEKDAY, BASIC_WEEK, BASIC_WEEKDAY = range(1, 10)
TIME, SIGN, OFFSET, GROUPS = 10, 17, 18, 24

# 0001-01-01T00:00:00Z and 9999-12-31T23:59:59Z in epoch seconds
FIRST_SECOND = -62135596800
LAST_SECOND = 253402300799


def parse_iso(text: Column) -> Column:
    """Instant of an ISO-8601 text, NULL if it is not one. No offset means UTC.

    A pattern comes before the cast because a bare cast also reads ``2026-01`` and ``12:00``, the latter
    as a time of today. Only other forms are read field by field.
    """
    usual = F.when(text.rlike(USUAL), text.try_cast("timestamp"))
    found = F.coalesce(usual, F.when(text.rlike(ANY_FORM), _by_fields(text)))
    in_range = (found >= F.timestamp_seconds(F.lit(FIRST_SECOND))) & (found < F.timestamp_seconds(F.lit(LAST_SECOND + 1)))
    return F.when(in_range, found)


def _by_fields(text: Column) -> Column:
    # one match writes all groups out: matched again for every group, the expression is too large to be compiled
    written = F.regexp_replace(text, ANY_FORM, ",".join(f"${n}" for n in range(1, GROUPS + 1)))
    return F.transform(F.array(F.split(written, ",", -1)), _of_groups)[0]


def _of_groups(groups: Column) -> Column:
    """The instant from the groups of ANY_FORM; those that took no part are empty."""

    def group(*numbers: int) -> Column:
        """The first of the groups that took part, as text."""
        return F.coalesce(*(F.when(groups[n - 1] != "", groups[n - 1]) for n in numbers))

    def number(*numbers: int) -> Column:
        return group(*numbers).cast("int")

    def clock(first: int) -> tuple[Column, Column, Column, Column]:
        """Hours, minutes, seconds and microseconds of the groups from ``first`` on; further digits are cut."""
        none = F.lit(0)
        parts = (number(first), number(first + 1, first + 4), number(first + 2, first + 5))
        digits = F.rpad(F.coalesce(group(first + 3, first + 6), F.lit("")), 6, "0")
        return *(F.coalesce(p, none) for p in parts), digits.cast("int")

    year, week = number(YEAR), number(WEEK, BASIC_WEEK)
    weekday = F.coalesce(number(WEEKDAY, BASIC_WEEKDAY), F.lit(1))
    fourth = F.make_date(year, F.lit(1), F.lit(4))  # always in week 1
    by_week = F.date_add(F.date_sub(fourth, F.weekday(fourth)), (week - 1) * 7 + weekday - 1)
    is_week = week.between(1, 53) & weekday.between(1, 7) & ((week < 53) | (F.weekofyear(by_week) == 53))
    by_month = F.try_to_date(F.concat_ws("-", group(YEAR), group(MONTH, BASIC_MONTH), group(DAY, BASIC_DAY)), "yyyy-MM-dd")
    day = F.when(week.isNull(), by_month).when(is_week, by_week)

    hours, minutes, seconds, micros = clock(TIME)
    o_hours, o_minutes, o_seconds, o_micros = clock(OFFSET)
    offset = (o_hours * 3600 + o_minutes * 60 + o_seconds).cast("bigint")
    on_the_clock = (hours < 24) & (minutes < 60) & (seconds < 60) & (offset < 86_400)
    ahead = F.when(group(SIGN) == "-", -1).otherwise(1)
    since = (hours * 3600 + minutes * 60 + seconds).cast("bigint") - ahead * offset
    whole = F.unix_date(day).cast("bigint") * 86_400 + since
    return F.when(on_the_clock, F.timestamp_micros(whole * 1_000_000 + micros - ahead * o_micros))


def from_epoch(seconds: Column) -> Column:
    """Instant of epoch seconds with a fraction, rounded half-even to microseconds; NULL out of range."""
    whole = F.when(seconds >= 0, F.floor(seconds)).otherwise(F.ceil(seconds))
    micros = F.rint((seconds - whole) * 1_000_000).cast("bigint")
    in_range = (seconds >= FIRST_SECOND) & (seconds < LAST_SECOND + 1)
    return F.when(in_range, F.timestamp_micros(whole.cast("bigint") * 1_000_000 + micros))


def to_iso(instant: Column) -> Column:
    """ISO-8601 text in UTC, the fraction only when there is one."""
    fraction = F.when(F.unix_micros(instant) % 1_000_000 == 0, F.lit("")).otherwise(F.date_format(instant, ".SSSSSS"))
    return F.concat(F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))


def newer_than(moment: Column, asof: Column, interval: str) -> Column:
    """True if ``moment`` lies strictly less than ``interval`` before ``asof`` (or after it)."""
    return moment > asof - F.expr(f"INTERVAL {interval}")


def short_error(message: Column) -> Column:
    """Error text as stored in the audit log: its first 1000 characters."""
    return F.left(message, F.lit(1000))
