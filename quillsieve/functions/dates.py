"""Dates in news texts, as column expressions that give UTC timestamps.

Whole values in a declared format (ISO 8601; ``Mon d, yyyy`` or ``d Mon yyyy`` with optional
weekday, time and zone) are read first, without a zone as UTC. Otherwise the first month-first,
then day-first date inside the text counts, read at +05:30. Days beyond a month's end roll over
into the next month. Values that a lenient engine parser would guess at are not dates here.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillsieve.functions.text import MONTHS, collapse, let, text

LOCAL_MINUTES = 330
_CLOCK = r"(?:,?\s+(\d{1,2}):(\d{2})(?::(\d{2}))?\s*(AM|PM)?)?"
_ZONE = r"\s*(Z|GMT|UTC|[+-]\d{2}:?\d{2})?"
_DAY = r"^(?i)(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+)?"
MONTH_FIRST = rf"(?i)({MONTHS})\.?\s+(\d{{1,2}}),?\s+(\d{{4}})(?:\s+(\d{{1,2}}):(\d{{2}})\s*(AM|PM)?)?"
DAY_FIRST = rf"(?i)(\d{{1,2}})\s+({MONTHS})\.?\s+(\d{{4}})(?:,?\s+(\d{{1,2}}):(\d{{2}})\s*(AM|PM)?)?"
WHOLE_MONTH_FIRST = rf"{_DAY}({MONTHS})\.?\s+(\d{{1,2}}),?\s+(\d{{4}}){_CLOCK}{_ZONE}$"
WHOLE_DAY_FIRST = rf"{_DAY}(\d{{1,2}})\s+({MONTHS})\.?,?\s+(\d{{4}}){_CLOCK}{_ZONE}$"
ISO = r"^(\d{4})-(\d{2})-(\d{2})(?:[T ](\d{2}):(\d{2})(?::(\d{2})([.]\d+)?)?)?\s*(Z|[+-]\d{2}:?\d{2})?$"


def _int(c: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")).try_cast("int"), F.lit(0))


def month_number(name: Column) -> Column:
    return ((F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.lower(F.substring(name, 1, 3))) + 2) / 3).cast("int")


def from_parts(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column, meridiem: Column, minutes_east: Column) -> Column:
    """A UTC timestamp; null unless year and month are fit for one."""
    m = F.lower(meridiem)
    h = F.when((m == "pm") & (hour < 12), hour + 12).when((m == "am") & (hour == 12), F.lit(0)).otherwise(hour)
    start = F.when((year >= 1) & month.between(1, 12), F.make_date(year, month, F.lit(1)))
    days = F.unix_date(start).cast("long") + day - 1
    return F.timestamp_seconds(days * 86400 + h * 3600 + (minute - minutes_east) * 60 + second)


def _east(zone: Column) -> Column:
    """Minutes east of UTC of a zone; none is UTC."""
    digits = F.regexp_replace(zone, "[^0-9]", "")
    minutes = _int(F.substring(digits, 1, 2)) * 60 + _int(F.substring(digits, 3, 2))
    return F.when(zone.startswith("-"), -minutes).otherwise(minutes)


def parse(c: Column) -> Column:
    """The timestamp that a news date stands for; null if none is found."""
    raw = F.regexp_replace(text(c), r"(?i)(?<![A-Za-z0-9_])(?:updated|published|last updated|posted)\s*(?:on|at)?\s*:?\s*", " ")
    raw = collapse(F.regexp_replace(raw, r"(?i)(?<![A-Za-z0-9_])(\d{1,2})(?:st|nd|rd|th)(?![A-Za-z0-9_])", "$1"))
    zoned = lambda x: F.regexp_replace(x, r"(?i)(?<![A-Za-z0-9_])IST(?![A-Za-z0-9_])", "+05:30")
    return let(raw, lambda x: F.when(x.rlike("[0-9]"), F.coalesce(let(zoned(x), _whole), _inside(x))))


def _groups(x: Column, pattern: str, n: int) -> Column:
    """The groups of a pattern's first match, by one match of the whole text; empty for one unused."""
    every = "|".join(f"${k}" for k in range(1, n + 1))
    return F.split(F.regexp_replace(x, rf"(?s)^.*?(?:{pattern}).*$", every), "[|]")


def _iso(x: Column) -> Column:
    def read(g: Column) -> Column:
        i = lambda k: _int(g[k - 1])
        fits = i(2).between(1, 12) & i(3).between(1, 31) & (i(4) < 25) & (i(5) < 60) & (i(6) < 60)
        micros = F.coalesce((g[6].try_cast("double") * 1_000_000).cast("long"), F.lit(0))
        when = from_parts(i(1), i(2), i(3), i(4), i(5), i(6), F.lit(""), _east(g[7]))
        return F.when(fits, F.timestamp_micros(F.unix_micros(when) + micros))

    return F.when(x.rlike(ISO), let(_groups(x, ISO, 8), read))


def _named(x: Column, pattern: str, n: int, month: int, day: int, second: int | None, meridiem: int, zone: int | None) -> Column:
    def read(g: Column) -> Column:
        seconds = _int(g[second - 1]) if second else F.lit(0)
        east = _east(g[zone - 1]) if zone else F.lit(LOCAL_MINUTES)
        return from_parts(_int(g[2]), month_number(g[month - 1]), _int(g[day - 1]), _int(g[3]), _int(g[4]), seconds, g[meridiem - 1], east)

    return F.when(x.rlike(pattern), let(_groups(x, pattern, n), read))


def _whole(x: Column) -> Column:
    """A value that is nothing but a date."""
    return F.coalesce(_iso(x), _named(x, WHOLE_MONTH_FIRST, 8, 1, 2, 6, 7, 8), _named(x, WHOLE_DAY_FIRST, 8, 2, 1, 6, 7, 8))


def _inside(x: Column) -> Column:
    """The first date within a text."""
    return F.coalesce(_named(x, MONTH_FIRST, 6, 1, 2, None, 6, None), _named(x, DAY_FIRST, 6, 2, 1, None, 6, None))


def iso_text(ts: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss.SSSZ`` in UTC, whatever the session's zone; empty for null."""
    millis = F.unix_millis(ts)
    local = F.timestamp_millis(millis)
    shown = F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), local.cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss.SSS")
    return F.coalesce(F.concat(shown, F.lit("Z")), F.lit(""))


def article_date(published: Column, created: Column) -> Column:
    return F.coalesce(parse(published), parse(created))


def created_at(created: Column, published: Column, fetched: Column, now: Column, shared: Column) -> Column:
    """Creation time of a payload; the start of its UTC day for an article of several cities."""
    ts = F.coalesce(parse(created), parse(published), parse(fetched), now)
    day = F.timestamp_seconds(F.floor(F.unix_micros(ts) / 86_400_000_000) * 86400)
    return F.when(F.coalesce(shared, F.lit(False)), day).otherwise(ts)


def notice_date(c: Column) -> Column:
    """The time in a notice's file name (``NEWS_yyyyMMddHHmm``), read at +05:30."""
    p = r"(?i)NEWS_(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})"
    g = lambda i: _int(F.regexp_extract(text(c), p, i))
    month = F.when(g(2).between(1, 12), g(2)).otherwise(F.lit(1))
    return F.when(text(c).rlike(p), from_parts(g(1), month, g(3), g(4), g(5), F.lit(0), F.lit(""), F.lit(LOCAL_MINUTES)))


def boundary(value: str | None, end_of_day: bool = False) -> datetime | None:
    """A bound of a date window, on the driver; a bare date is the day's first or last moment."""
    value = (value or "").strip()
    if not value:
        return None
    try:
        if len(value) == 10:
            day = datetime.strptime(value, "%Y-%m-%d").replace(tzinfo=UTC)
            return day + timedelta(days=1, milliseconds=-1) if end_of_day else day
        found = datetime.fromisoformat(value.replace("Z", "+00:00"))
    except ValueError as e:
        raise ValueError(f"{value} is no date or ISO timestamp") from e
    return found if found.tzinfo else found.replace(tzinfo=UTC)


def window(start: str | None, end: str | None, now: datetime, lookback_days: int = 20) -> tuple[datetime | None, datetime | None]:
    """The inclusive date window; without bounds the last days before now."""
    lo, hi = boundary(start), boundary(end, True)
    if lo is None and hi is None:
        return now - timedelta(days=lookback_days), now
    if lo and hi and lo > hi:
        raise ValueError("the window's start is after its end")
    return lo, hi
