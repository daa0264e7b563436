"""Period averages disclosed in press-release text.

Each publisher style is a set of phrasings plus the rules for a missing year; a document is read by
every phrasing in one pass and its matches explode into typed rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgrid.functions.dates import MONTH_RE, MONTHS, article_date, infer_year, month_end, month_no, month_start, page_date
from newsgrid.functions.frames import staged
from newsgrid.functions.text import contains_any, strip_tags
from newsgrid.operators.dedupe import first_per_key

# The phrasings publishers use. Groups: month, year, value (monthly); month, year,
# month, year, value (two-month); value, period text (modern).
_M = f"({MONTH_RE})"
_Y = r"(20\d{2})"
_USD = r"(?:USD|US\$|USD\$)"
_NUM = r"([0-9]+(?:\.[0-9]+)?)"

CARGO_MONTHLY = [
    rf"average price of (?:jet fuel|Singapore kerosene)(?:[^.]){{0,100}}?(?:for )?the month of\s+{_M}(?:\s+{_Y})?\s*[,;:]?\s*{_USD}\s*\$?\s*{_NUM}",
    rf"average (?:fuel )?price of Singapore kerosene(?:[^.]){{0,100}}?(?:for )?the month of\s+{_M}(?:\s+{_Y})?\s+was\s+{_USD}?\s*\$?\s*{_NUM}",
    rf"Singapore kerosene(?:-type jet fuel)?(?:[^.]){{0,100}}?\b(?:in|of)\s+{_M}(?:\s+{_Y})?(?:[^.]){{0,80}}?{_USD}\s*\$?\s*{_NUM}",
]
CARGO_MODERN = [
    rf"average price being\s+{_USD}?\s*\$?\s*{_NUM}\s*(?:/bbl|per barrel)?\s+for the period of\s+([^.;]{{1,100}})",
]
CARGO_ARCHIVE_MONTHLY = [
    rf"average price of (?:jet fuel|Singapore kerosene)(?:[^.]){{0,140}}?(?:for )?(?:the )?month of\s+{_M}(?:\s+{_Y})?(?:[^.]){{0,100}}?{_USD}\s*\$?\s*{_NUM}",
    rf"average (?:fuel )?price of Singapore kerosene(?:[^.]){{0,140}}?\b(?:in|of|for)\s+{_M}(?:\s+{_Y})?(?:[^.]){{0,100}}?{_USD}\s*\$?\s*{_NUM}",
    rf"according to the average price of jet fuel for the month of\s+{_M}(?:\s+{_Y})?\s*,?\s*{_USD}?\s*\$?\s*{_NUM}",
]
CARRIER_MONTHLY = [
    rf"average fuel price of Singapore kerosene(?:-type jet fuel)?\s+(?:for the month of|in)\s+({MONTHS})\s+(?:in\s+)?{_Y}\s+was\s+US\$\s*{_NUM}",
]
CARRIER_TWO_MONTH = [
    rf"price of Singapore kerosene-type jet fuel\s+during the two-month period of\s+({MONTHS})(?:\s+{_Y})?\s+and\s+({MONTHS})(?:\s+{_Y})?\s+averaged\s+USD\s*\$?\s*{_NUM}",
]
CARRIER_ARCHIVE_MONTHLY = [
    rf"average fuel price of Singapore kerosene(?:-type jet fuel)?\s+(?:for )?(?:the )?month of\s+{_M}(?:\s+(?:in\s+)?{_Y})?\s+was\s+(?:US\$|USD\s*\$?|USD)?\s*{_NUM}\s+per barrel",
    rf"average (?:fuel )?price of Singapore kerosene(?:-type jet fuel)?\s+(?:for )?(?:the )?month of\s+{_M}(?:\s+(?:in\s+)?{_Y})?(?:[^.]){{0,80}}?(?:US\$|USD\s*\$?)\s*{_NUM}",
]
CARRIER_ARCHIVE_TWO_MONTH = [
    rf"(?:two-month|2-month) average (?:fuel )?price of Singapore kerosene(?:-type jet fuel)?(?:[^.]){{0,120}}?{_M}(?:\s+{_Y})?\s+(?:and|to|-)\s+{_M}(?:\s+{_Y})?(?:[^.]){{0,100}}?(?:US\$|USD\s*\$?)\s*{_NUM}",
    rf"price of Singapore kerosene(?:-type jet fuel)?\s+during the two-month period of\s+{_M}(?:\s+{_Y})?\s+and\s+{_M}(?:\s+{_Y})?\s+averaged\s+(?:US\$|USD\s*\$?)\s*{_NUM}",
]


MONTHLY, MODERN, TWO_MONTH = 0, 50, 100  # first rule number of each kind of phrasing


@dataclass(frozen=True)
class Style:
    """How one kind of publisher discloses averages."""

    name: str
    monthly: tuple = ()
    two_month: tuple = ()
    modern: tuple = ()
    must: tuple = ()  # groups of words; each group needs one present
    lo: float = 15
    hi: float = 350
    dated_by: str = "page"  # page: numeric date in the text; article: written date or URL; none: years must be given
    years: tuple = (2010, 2027)
    last_wins: bool = True  # repeated date in one release: last match, else monthly first


CARGO = Style("cargo", tuple(CARGO_MONTHLY), modern=tuple(CARGO_MODERN), must=(("fuel surcharge",), ("singapore kerosene", "average price of jet fuel")))
CARGO_ARCHIVE = Style("cargo_archive", tuple(CARGO_ARCHIVE_MONTHLY), must=(("fuel surcharge",),), years=(2010, 2020))
CARRIER = Style("carrier", tuple(CARRIER_MONTHLY), tuple(CARRIER_TWO_MONTH), lo=20, hi=300, dated_by="none", last_wins=False)
CARRIER_ARCHIVE = Style(
    "carrier_archive", tuple(CARRIER_ARCHIVE_MONTHLY), tuple(CARRIER_ARCHIVE_TWO_MONTH), must=(("singapore kerosene",),), dated_by="article", last_wins=False
)
STYLES = {s.name: s for s in (CARGO, CARGO_ARCHIVE, CARRIER, CARRIER_ARCHIVE)}


def _matches(docs: DataFrame, style: Style) -> DataFrame:
    """(doc columns, rule, pos, g): every match of every pattern with its groups, in one pass over the documents."""
    parts = []
    for first_rule, patterns in ((MONTHLY, style.monthly), (MODERN, style.modern), (TWO_MONTH, style.two_month)):
        for i, p in enumerate(patterns):
            pattern = "(?i)" + p
            n_groups = 5 if p.count("(20") == 2 else 3 if p.count("(20") == 1 else 2
            found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
            # Groups are read back from the matched text; a trailing lazy gap cannot end differently there.
            groups = lambda m, pattern=pattern, n=n_groups: F.array(*[F.regexp_extract(m, pattern, g) for g in range(1, n + 1)])
            parts.append(F.transform(found, _tagged(first_rule + i, groups)))
    exploded = docs.select("*", F.explode(F.concat(*parts)).alias("x"))
    return exploded.select(*docs.columns, "x.rule", "x.pos", "x.g")


def _tagged(rule: int, groups):
    return lambda m, i: F.struct(F.lit(rule).alias("rule"), i.alias("pos"), groups(m).alias("g"))


def _year(text):
    return F.nullif(text, F.lit("")).try_cast("int")


def disclosed_averages(docs: DataFrame, style: Style, gap: tuple | None = None) -> DataFrame:
    """Typed period averages of (doc_id, url, text) documents, one per document and end date."""
    base = staged(docs.select("doc_id", "url", "text"), {"text": strip_tags("text")})  # cleaned once, whatever reads it
    low = F.lower("text")
    for words in style.must:
        base = base.filter(contains_any(low, words))
    said = {"page": page_date(F.col("text"), *style.years), "article": article_date("text", "url")}.get(style.dated_by, F.lit(None).cast("date"))
    rows = _matches(base.withColumn("said", said), style)
    g = lambda n: F.get("g", F.lit(n))
    period = lambda y1, m1, y2, m2, value, kind: F.struct(
        month_start(y1, m1).alias("period_start"), month_end(y2, m2).alias("period_end"), value.try_cast("double").alias("value"), F.lit(kind).alias("observation_type")
    )
    month = month_no(g(0))
    year = F.coalesce(_year(g(1)), infer_year(month, "said"))
    monthly = period(year, month, year, month, g(2), "monthly_average")
    month = month_no(F.regexp_extract(g(1), "(?i)" + MONTH_RE, 0))
    year = F.coalesce(_year(F.regexp_extract(g(1), r"20\d{2}", 0)), infer_year(month, "said"))
    modern = period(year, month, year, month, g(0), "monthly_average")
    m1, y1, m2, y2 = month_no(g(0)), _year(g(1)), month_no(g(2)), _year(g(3))
    end_year = F.coalesce(y2, F.when(y1.isNotNull(), F.when(m2 < m1, y1 + 1).otherwise(y1)), infer_year(m2, "said"))
    start_year = F.coalesce(y1, F.when(m1 > m2, end_year - 1).otherwise(end_year))
    two_month = period(start_year, m1, end_year, m2, g(4), "two_month_average")
    read = F.when(F.col("rule") < MODERN, monthly).when(F.col("rule") < TWO_MONTH, modern).otherwise(two_month)
    out = rows.select("doc_id", "url", "rule", "pos", F.inline(F.array(read)))
    kept = out.filter(F.col("period_start").isNotNull() & F.col("period_end").isNotNull() & F.col("value").between(style.lo, style.hi))
    if gap:
        kept = kept.filter(F.col("period_end").between(F.lit(gap[0]).cast("date"), F.lit(gap[1]).cast("date")))
    numbered = kept.withColumn("value", F.bround("value", 2))
    fine = F.when(F.col("observation_type") == "monthly_average", F.lit(1)).otherwise(F.lit(0))
    order = [F.desc("rule"), F.desc("pos")] if style.last_wins else [fine.desc(), F.asc("rule"), F.asc("pos")]
    return first_per_key(numbered, ["doc_id", "period_end"], order).drop("rule", "pos")
