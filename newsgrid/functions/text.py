"""Text column functions. Every function maps Columns to Columns and stays JVM-side."""

from __future__ import annotations

import html.entities
import json
import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsgrid import dims

_WS = r"(?U:[\s\x1c-\x1f])"
# Runs other than one space, which stays as it is; the Unicode class is asked only at spaces and outside printable ASCII.
_WS_RUN = rf" {_WS}++|[^ -~](?<={_WS}){_WS}*+"


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value, fn) -> Column:
    """Evaluate ``value`` once and hand it to ``fn`` as a column it may use many times."""
    return F.get(F.transform(F.array(as_col(value)), fn), F.lit(0))


def ws_clean(c) -> Column:
    """Collapse every whitespace run (NBSP included) to one space; null becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(as_col(c), F.lit("")), _WS_RUN, " "))


def title_norm(c) -> Column:
    return F.trim(F.regexp_replace(F.lower(ws_clean(c)), "[^a-z0-9]+", " "))


def token_set(c, stop=tuple(dims.STOP_WORDS)) -> Column:
    """Distinct normalised words longer than one character that are not stop words, sorted."""
    words = F.array_distinct(F.split(title_norm(c), " "))
    return F.array_sort(F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(list(stop))))


def token_jaccard(a, b) -> Column:
    """|A∩B| / |A∪B| of two token arrays, 0 when either side is empty."""
    a, b = as_col(a), as_col(b)
    shared = F.size(F.array_intersect(a, b)).cast("double")
    return F.when((F.size(a) > 0) & (F.size(b) > 0), shared / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


def _entity_map() -> Column:
    names = {k[:-1]: v for k, v in html.entities.html5.items() if k.endswith(";")}
    return F.from_json(F.lit(json.dumps(names, ensure_ascii=False)), "map<string,string>")


# The references nearly every page uses, tried before the full name table.
COMMON_REFS = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "nbsp": "\u00a0", "#39": "'"}


def html_unescape(c) -> Column:
    """Decode named and numeric character references that end in a semicolon."""
    names = _entity_map()

    def char_of(ref: Column) -> Column:
        digits = F.when(
            F.lower(F.substring(ref, 1, 2)) == "#x", F.lpad(F.upper(F.substring(ref, 3, 8)), 8, "0")
        ).when(F.substring(ref, 1, 1) == "#", F.lpad(F.conv(F.substring(ref, 2, 8), 10, 16), 8, "0"))
        common = F.coalesce(*[F.when(ref == k, F.lit(v)) for k, v in COMMON_REFS.items()])
        numeric = F.when((digits <= "0010FFFF") & (digits > "00000000"), F.decode(F.unhex(digits), "UTF-32"))
        return F.when(ref == "", F.lit(None)).otherwise(F.coalesce(common, numeric, F.try_element_at(names, ref)))

    def decode(part: Column) -> Column:
        ref = F.regexp_extract(part, r"^(#[xX][0-9a-fA-F]{1,6}|#[0-9]{1,7}|[A-Za-z][A-Za-z0-9]{1,31});", 1)
        rest = F.regexp_replace(part, r"^[#A-Za-z0-9]+;", "")
        return F.coalesce(F.concat(char_of(ref), rest), F.concat(F.lit("&"), part))

    def whole(v: Column) -> Column:
        parts = F.split(v, "&")
        tail = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), decode)
        return F.when(v.contains("&"), F.concat(parts[0], F.array_join(tail, ""))).otherwise(v)

    return bind(c, whole)


HIDDEN_MARKUP = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<template\b.*?</template\s*>|<!--.*?-->"


def strip_tags(c) -> Column:
    """Visible text of markup: hidden elements and tags become spaces, whitespace collapses."""
    swept = lambda v, pattern: F.when(v.contains("<"), F.regexp_replace(v, pattern, " ")).otherwise(v)
    shown = bind(c, lambda v: swept(v, HIDDEN_MARKUP))
    return ws_clean(html_unescape(bind(shown, lambda v: swept(v, r"<[!/?]?[A-Za-z][^>]*>"))))


def strip_html(c) -> Column:
    """Decode references, then take the visible text."""
    return strip_tags(html_unescape(F.coalesce(as_col(c), F.lit(""))))


def truncate(c, limit: int = 600) -> Column:
    v = ws_clean(c)
    cut = F.concat(F.rtrim(F.substring(v, 1, limit - 1)), F.lit("…"))
    return F.when(F.length(v) <= limit, v).otherwise(cut)


def non_empty(values) -> Column:
    return F.filter(as_col(values), lambda x: x.isNotNull() & (x != ""))


def distinct_ci(values) -> Column:
    """Distinct strings compared case-insensitively, keeping the first spelling of each."""

    def firsts(v: Column, lows: Column) -> Column:
        said = F.filter(F.array_distinct(lows), lambda x: x.isNotNull())
        return F.transform(said, lambda x: F.get(v, (F.array_position(lows, x) - 1).cast("int")))

    return bind(values, lambda v: bind(F.transform(v, lambda x: F.lower(x)), lambda lows: firsts(v, lows)))


def contains_any(low, terms) -> Column:
    """True when the (already lower-cased) text holds any term as a substring.

    A term that holds another one is left out: a text with it has the shorter one too.
    """
    low = as_col(low)
    asked = dict.fromkeys(" ".join(t.split()).lower() for t in terms)
    hits = [low.contains(t) for t in asked if t and not any(u and u != t and u in t for u in asked)]
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def count_terms(low, terms) -> Column:
    low = as_col(low)
    return reduce(lambda a, b: a + b, [low.contains(t).cast("int") for t in terms], F.lit(0))


_CJK = re.compile("[㐀-鿿]")


def is_phrase(alias: str) -> bool:
    return bool(_CJK.search(alias)) or any(ch in alias for ch in " -'")


def alias_match(low, alias: str) -> Column:
    """Phrase aliases match as substrings; single words need non-[a-z0-9] neighbours."""
    low = as_col(low)
    needle = " ".join(alias.split()).lower()
    if not needle:
        return F.lit(False)
    if is_phrase(needle):
        return low.contains(needle)
    return low.contains(needle) & low.rlike(r"(?<![a-z0-9])" + re.escape(needle) + r"(?![a-z0-9])")


def scoring_text(title, category, region, entities, snippets) -> Column:
    head = F.array(ws_clean(title), ws_clean(category), ws_clean(region))
    ents = F.transform(F.coalesce(as_col(entities), F.array().cast("array<string>")), ws_clean)
    return F.array_join(non_empty(F.concat(head, ents, as_col(snippets))), " | ")


def search_text(title, summary, why, entities, companies, models, topics) -> Column:
    empty = F.array().cast("array<string>")
    head = F.array(*[F.coalesce(as_col(x), F.lit("")) for x in (title, summary, why)])
    lists = [F.coalesce(as_col(x), empty) for x in (entities, companies, models, topics)]
    return F.lower(F.array_join(F.concat(head, *lists), " "))


# Fixed value: the shape of an aircraft or engine model code once separators are removed.
MODEL_KEY_PATTERN = (
    r"^(?:A(?:220|319|320|321|330|340|350|380)(?:\d{3,4})?(?:NEO|XLR)?|B?7(?:37|47|67|77|87)(?:\d{3,4}|MAX\d*)?|"
    r"E(?:170|175|190|195)(?:E2)?|CRJ(?:200|700|900|1000)|C(?:909|919|929)|ARJ21|ATR(?:42|72)(?:\d{3})?|"
    r"PW(?:1100G|1500G)|LEAP1[ABC]|CFM56|GENX(?:\dB)?|GE9X|TRENT(?:7000|1000|XWB|700|800|900))$"
)


def model_key(c) -> Column:
    return F.regexp_replace(F.upper(F.coalesce(as_col(c), F.lit(""))), r"(?U)[\s\-_/().]", "")


def is_model_code(c) -> Column:
    return model_key(c).rlike(MODEL_KEY_PATTERN)
