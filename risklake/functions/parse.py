"""Tolerant text-to-value parsing as built-in column expressions.

The rules are those of SQLite's CAST, DATE and JULIANDAY: a number is the longest numeric prefix and garbage is 0, a
date is a strict ISO day with an optional clock and zone and anything else is NULL. NULL always stays NULL. No function
here depends on the session time zone, and none raises under ANSI mode.
"""

from pyspark.sql import Column, DataFrame, functions as F

_BLANK = r"[ \t\n\x0B\f\r]*"
_SPACES = " \t\n\x0b\f\r"
INTEGER_PREFIX = rf"^{_BLANK}([+-]?[0-9]+)"
REAL_PREFIX = rf"^{_BLANK}([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"
_DAY = r"[0-9]{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])"
DAY = rf"^{_DAY}$"
MOMENT = (
    rf"^({_DAY})[ \t\n\x0B\f\rT]*"
    rf"(?:([01][0-9]|2[0-4]):([0-5][0-9])(?::([0-5][0-9](?:\.[0-9]+)?))?{_BLANK}"
    rf"(?:[zZ]|([+-])(0[0-9]|1[0-4]):([0-5][0-9]))?)?{_BLANK}$"
)

# 64-bit integer range, milliseconds in a day, longest text, Julian date of 1970-01-01 in milliseconds.
LONG_MAX = 9223372036854775807
LONG_MIN = -9223372036854775808
DAY_MILLIS = 86400000
LONGEST = 2147483647
JULIAN_EPOCH_MILLIS = 210866760000000


def to_integer(text: Column) -> Column:
    """Leading integer of ``text`` as a long; 0 where there is none, held within the long range."""
    digits = F.regexp_extract(text, INTEGER_PREFIX, 1)
    bound = F.when(digits.startswith("-"), F.lit(str(LONG_MIN)).cast("long")).otherwise(F.lit(LONG_MAX))
    # no digits are no cast, which would fail at the cost of an exception; what is left of it is looked at only then
    number = F.nullif(digits, F.lit("")).try_cast("long")
    return F.when(text.isNotNull(), F.coalesce(number, F.when(digits == "", F.lit(0).cast("long")).otherwise(bound)))


def to_real(text: Column) -> Column:
    """Leading number of ``text`` as a double; 0.0 where there is none. A comma ends the number."""
    number = F.nullif(F.regexp_extract(text, REAL_PREFIX, 1), F.lit("")).cast("double")
    return F.coalesce(number, F.when(text.isNotNull(), F.lit(0.0)))


def _first_day(text: Column) -> Column:
    """The day that ``text`` begins with; NULL if the calendar lacks it."""
    return F.substring(text, 1, 10).try_cast("date")


def _midnight(text: Column, day: Column) -> Column:
    """Milliseconds of ``day``, the ``_first_day`` of ``text``; a day that its month lacks is counted from the first."""
    month = F.concat(F.substring(text, 1, 7), F.lit("-01")).try_cast("date")
    lacking = F.unix_date(month) + F.substring(text, 9, 2).cast("int") - 1
    return F.coalesce(F.unix_date(day), lacking).cast("long") * DAY_MILLIS


def _clock(text: Column) -> Column:
    """The clock and zone of a moment, '' if it has none; NULL unless ``text`` is a moment longer than a day."""
    clock = F.rtrim(F.ltrim(F.substring(text, 11, LONGEST), F.lit(_SPACES + "T")), F.lit(_SPACES))
    # a moment is ASCII, so its bytes are its characters
    return F.when(F.octet_length(text) > 10, F.when(text.rlike(MOMENT), clock))


def _digits(clock: Column) -> Column:
    return F.replace(clock, F.lit(":"), F.lit(""))


def _time(clock: Column) -> Column:
    """Hour, minute, second and milliseconds as one number. They stand at fixed places; of a fraction three digits count."""
    seconds = F.replace(F.regexp_extract(clock, r"^.{5}:([0-9]{2}(?:[.][0-9]{1,3})?)", 1), F.lit("."), F.lit(""))
    return F.when(clock != "", F.rpad(F.concat(_digits(F.substring(clock, 1, 5)), seconds), 9, "0").cast("long"))


def _zone(clock: Column) -> Column:
    """Hours and minutes east as one number; NULL without. A clock without a zone has no sign six places from its end."""
    zone = F.substring(clock, -6, 6)
    return F.when(zone.startswith("+") | zone.startswith("-"), _digits(zone).cast("long"))


def _millis(text: Column, first: Column, clock: Column, time: Column, zone: Column) -> Column:
    def part(number: Column, unit: int) -> Column:
        return F.call_function("div", number, F.lit(unit).cast("long"))

    # from places of a decimal number to milliseconds: 100 minutes, not 60, make its hour
    since = time - part(time, 10**5) * 40000 - part(time, 10**7) * 2400000
    east = (zone - part(zone, 100) * 40) * 60000
    zero = F.lit(0).cast("long")
    day = F.when(F.octet_length(text) == 10, text.rlike(DAY)).otherwise(clock.isNotNull())
    return F.when(day, _midnight(text, first) + F.coalesce(since, zero) - F.coalesce(east, zero))


def to_millis(text: Column) -> Column:
    """Milliseconds from 1970-01-01 UTC to the moment in ``text``; NULL unless it is a strict ISO day or moment.

    A day that its month lacks is the day so many days after the first, as delays are counted over it; ``to_date``
    shows none for it. Hour 24 is the next day. In one expression; ``with_millis`` computes each part once.
    """
    clock = _clock(text)
    return _millis(text, _first_day(text), clock, _time(clock), _zone(clock))


def with_millis(df: DataFrame, texts: dict[str, Column], days: dict[str, str] | None = None) -> DataFrame:
    """Add ``to_millis`` of each text under its name, and ``to_date`` of it under the name that ``days`` has for that. The parts
    are columns of their own until then, so that each is computed once and generated code stays within what is compiled."""
    kept, days = [F.col(f"`{c}`") for c in df.columns], days or {}
    parts = {f"_text{i}": text for i, text in enumerate(texts.values())}
    clocks = {f"_{kind}{i}": f(F.col(f"_text{i}")) for i in range(len(texts)) for kind, f in (("first", _first_day), ("clock", _clock))}
    numbers = {f"_{kind}{i}": f(F.col(f"_clock{i}")) for i in range(len(texts)) for kind, f in (("time", _time), ("zone", _zone))}
    done = [
        _millis(*(F.col(f"_{kind}{i}") for kind in ("text", "first", "clock", "time", "zone"))).alias(name)
        for i, name in enumerate(texts)
    ]
    firsts = {name: F.col(f"_first{i}") for i, name in enumerate(texts) if name in days}
    found = df.withColumns(parts).withColumns(clocks).withColumns(numbers).select(*kept, *firsts.values(), *done)
    shown = [F.when(first.isNotNull(), millis_to_date(F.col(f"`{name}`"))).alias(days[name]) for name, first in firsts.items()]
    return found.select(*kept, *[F.col(f"`{name}`") for name in texts], *shown)


def has_calendar_day(text: Column) -> Column:
    """Whether the month of ``text`` has its day."""
    return _first_day(text).isNotNull()


def millis_to_date(millis: Column) -> Column:
    """UTC calendar day."""
    return F.date_from_unix_date(F.floor(millis / F.lit(float(DAY_MILLIS))).cast("int"))


def millis_to_julian(millis: Column) -> Column:
    """Fractional Julian day number."""
    return (millis + JULIAN_EPOCH_MILLIS) / F.lit(float(DAY_MILLIS))


def calendar_day(text: Column, millis: Column) -> Column:
    """``to_date`` of a text whose ``to_millis`` is known."""
    return F.when(has_calendar_day(text), millis_to_date(millis))


def to_date(text: Column) -> Column:
    """UTC calendar day of ``text``; NULL unless it is a strict ISO day or moment that the calendar has."""
    return calendar_day(text, to_millis(text))
