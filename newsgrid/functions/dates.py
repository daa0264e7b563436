"""Date and time column functions. Instants are TIMESTAMP_NTZ holding UTC wall time, so results
never depend on the session time zone; ``as_of`` is always an argument, never the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsgrid.functions.text import as_col, bind, strip_html

# English month names and the zone names mail dates may carry.
MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december"
MONTH_ABBR = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
ZONE_HOURS = {"EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7}

MONTH_RE = f"(?:{MONTHS}|{MONTH_ABBR})"
LONG_DATE_RE = rf"(?iU)\b(\d{{1,2}})(?:st|nd|rd|th)?\s+({MONTHS})\s+(20\d{{2}})\b"


def as_of_lit(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def month_no(name) -> Column:
    """1..12 from an English month name or abbreviation, null otherwise."""
    numbers = {n: i for names in (MONTHS, MONTH_ABBR) for i, n in enumerate(names.split("|"), 1)}
    table = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
    return F.try_element_at(table, F.lower(F.rtrim(as_col(name), F.lit("."))))


def _int(c: Column) -> Column:
    return c.try_cast("int")


def make_ts(y, m, d, h=None, mi=None, s=None) -> Column:
    zero = F.lit(0)
    return F.try_make_timestamp_ntz(
        _int(y), m.cast("int"), _int(d), *(F.coalesce(_int(x), zero) if x is not None else zero for x in (h, mi)),
        (F.coalesce(_int(s), zero) if s is not None else zero).cast("decimal(16,6)"),
    )


def seconds_between(later, earlier) -> Column:
    """Whole seconds from ``earlier`` to ``later`` (TIMESTAMP_NTZ)."""
    return F.timestamp_diff("SECOND", as_col(earlier), as_col(later))


def add_seconds(ts, seconds) -> Column:
    return F.timestamp_add("SECOND", as_col(seconds).cast("int"), as_col(ts))


_MAIL = (
    r"^(?:[A-Za-z]+,\s*)?(\d{1,2}) ([A-Za-z]{3,9}) (\d{4}) (\d{1,2}):(\d{2})(?::(\d{2}))?"
    r"(?: ([A-Za-z]{1,5}|[+-]\d{4}))?"
)


def _offset_seconds(zone: Column) -> Column:
    sign = F.when(zone.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    digits = F.regexp_replace(zone, "[^0-9]", "")
    numeric = sign * (_int(F.substring(digits, 1, 2)) * 3600 + F.coalesce(_int(F.substring(digits, 3, 2)), F.lit(0)) * 60)
    named = F.lit(0)
    for name, hours in ZONE_HOURS.items():
        named = F.when(F.upper(zone) == name, F.lit(hours * 3600)).otherwise(named)
    return F.when(digits != "", numeric).otherwise(named)


def parse_mail_date(v) -> Column:
    v = as_col(v)
    g = [F.regexp_extract(v, _MAIL, i) for i in range(8)]
    local = make_ts(g[3], month_no(g[2]), g[1], g[4], g[5], g[6])
    return add_seconds(local, -_offset_seconds(g[7]))


def find_long_date(v) -> Column:
    """First "11th September 2026" anywhere in the text."""
    v = as_col(v)
    return make_ts(
        F.regexp_extract(v, LONG_DATE_RE, 3), month_no(F.regexp_extract(v, LONG_DATE_RE, 2)), F.regexp_extract(v, LONG_DATE_RE, 1)
    )


def _whole(v: Column, pattern: str, y: int, m: int, d: int, named: bool) -> Column:
    month = F.regexp_extract(v, pattern, m)
    read = make_ts(F.regexp_extract(v, pattern, y), month_no(month) if named else _int(month), F.regexp_extract(v, pattern, d))
    return F.when(v.rlike(pattern), read)


def parse_date_multi(c) -> Column:
    """Mail date, long date inside text, ISO date, "11 Sep 2026", "Sep 11, 2026"; first that parses wins."""
    return bind(
        strip_html(c),
        lambda v: F.coalesce(
            parse_mail_date(v),
            find_long_date(v),
            _whole(v, r"^(\d{4})-(\d{1,2})-(\d{1,2})$", 1, 2, 3, False),
            _whole(v, r"^(\d{1,2}) ([A-Za-z]{3}) (\d{4})$", 3, 2, 1, True),
            _whole(v, r"^([A-Za-z]{3,9}) (\d{1,2}), (\d{4})$", 3, 1, 2, True),
        ),
    )


def parse_day(c) -> Column:
    """Calendar day written as ISO, "2 January 2024", "2 Jan 2024", "January 2 2024" or "Jan 2, 2024"."""
    return bind(
        F.trim(F.regexp_replace(F.replace(as_col(c), F.lit(","), F.lit(" ")), r"(?U)\s+", " ")),
        lambda v: F.coalesce(
            _whole(v, r"^(\d{4})-(\d{1,2})-(\d{1,2})$", 1, 2, 3, False),
            _whole(v, r"^(\d{1,2}) ([A-Za-z]{3,9}) (\d{4})$", 3, 2, 1, True),
            _whole(v, r"^([A-Za-z]{3,9}) (\d{1,2}) (\d{4})$", 3, 1, 2, True),
        ).cast("date"),
    )


_ISO = (
    r"^(\d{4})-(\d{2})-(\d{2})(?:[T ](\d{2}):(\d{2})(?::(\d{2})(?:\.\d+)?)?)?(?:(Z)|([+-]\d{2}:?\d{2}))?$"
)


def parse_iso_utc(c) -> Column:
    """ISO date-time with Z, an offset or none (then UTC), to whole UTC seconds; null if malformed."""
    c = as_col(c)
    g = [F.regexp_extract(c, _ISO, i) for i in range(9)]
    local = make_ts(g[1], _int(g[2]), g[3], g[4], g[5], g[6])
    return add_seconds(local, -_offset_seconds(g[8]))


def format_iso_utc(ts) -> Column:
    return F.date_format(as_col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def local_time(ts, zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), as_col(ts))


def epoch_ms_date(c) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(as_col(c) / 86400000).cast("int"))


def epoch_s_date(c) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(as_col(c) / 86400).cast("int"))


def month_end(year, month) -> Column:
    return F.last_day(month_start(year, month))


def month_start(year, month) -> Column:
    return make_ts(as_col(year), as_col(month), F.lit(1)).cast("date")


def infer_year(month, day) -> Column:
    """Year of a month named without one: the month never lies after the article's date."""
    month, day = as_col(month), as_col(day)
    return F.when(month > F.month(day), F.year(day) - 1).otherwise(F.year(day))


def article_date(text, url) -> Column:
    """First "Sep 08, 2015" in the text, else the 15th of a yyyyMM folder in the URL."""
    text, url = as_col(text), as_col(url)
    short = r"\b([A-Za-z]{3})\s+(\d{1,2}),\s*(20\d{2})\b"
    long = r"\b([A-Za-z]+)\s+(\d{1,2}),\s*(20\d{2})\b"
    first = lambda p: bind(F.regexp_extract(text, p, 0), lambda m: _whole(m, p, 3, 1, 2, True))  # one scan of the text
    folder = r"/en/release/(20\d{2})(\d{2})/"
    return F.coalesce(
        first(short), first(long),
        make_ts(F.regexp_extract(url, folder, 1), _int(F.regexp_extract(url, folder, 2)), F.lit(15)),
    ).cast("date")


def page_date(text, first_year: int = 2010, last_year: int = 2027) -> Column:
    """First valid numeric date 20YY.M.D (also / or -) whose year lies in the bounds."""
    found = F.regexp_extract_all(as_col(text), F.lit(r"\b(20\d{2}[./-]\d{1,2}[./-]\d{1,2})\b"), F.lit(1))
    days = F.transform(
        found,
        lambda x: make_ts(
            F.substring(x, 1, 4), _int(F.split(x, "[./-]")[1]), F.split(x, "[./-]")[2]
        ).cast("date"),
    )
    return F.get(F.filter(days, lambda d: d.isNotNull() & F.year(d).between(first_year, last_year)), F.lit(0))


def age(ts, as_of, unit_seconds: int) -> Column:
    """max(0, as_of − ts) in the given unit, null when ts is null."""
    raw = seconds_between(as_of, ts) / F.lit(float(unit_seconds))
    return F.when(as_col(ts).isNotNull(), F.greatest(F.lit(0.0), raw))
