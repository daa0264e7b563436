"""Dictionary and pattern classification, compiled into column expressions (no join, no UDF)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsgrid import dims
from newsgrid.functions.text import alias_match, as_col, bind, contains_any, count_terms, distinct_ci, ws_clean


def _opened(pattern: str) -> str:
    """A look at the first letter before ``\\b(?:x|y)\\b``, as the test for a word's begin costs more; others as they are."""
    body = re.fullmatch(r"\\b\(\?:(.*)\)\\b", pattern)
    words, depth = [""], 0
    for ch in body[1] if body else "":
        depth += (ch == "(") - (ch == ")")
        if ch == "|" and not depth:
            words.append("")
        else:
            words[-1] += ch
        if depth < 0:
            return pattern
    plain = all(re.match(r"[A-Za-z0-9](?![?*{])", w) for w in words) and not re.search(r"\\[()|]", pattern)
    return f"(?=[{''.join(sorted({w[0] for w in words}))}]){pattern}" if plain else pattern


def _found(c: Column, pattern: str) -> Column:
    return F.transform(F.regexp_extract_all(c, F.lit("(?iU)" + _opened(pattern)), F.lit(0)), ws_clean)


def extract_terms(title, summary, patterns=tuple(dims.ENTITY_PATTERNS), cap: int = 16) -> Column:
    """Pattern matches in title and summary, group by group, case-insensitively distinct, capped."""
    parts = F.filter(F.array(ws_clean(title), ws_clean(summary)), lambda x: x != "")
    text = F.array_join(parts, " | ")
    return bind(text, lambda t: F.slice(distinct_ci(F.concat(*[_found(t, p) for p in patterns])), 1, cap))


def model_tags(text, entities, cap: int = 12) -> Column:
    pattern = r"\b(?:" + dims.MODEL_PATTERN + r")\b"
    nested = F.transform(as_col(entities), lambda e: _found(ws_clean(e), pattern))
    codes = F.concat(_found(as_col(text), pattern), F.coalesce(F.flatten(nested), F.array().cast("array<string>")))
    return F.slice(F.array_distinct(F.transform(codes, lambda x: F.replace(F.upper(x), F.lit(" "), F.lit("")))), 1, cap)


def category_of(scores, channel, names=tuple(dims.KEYWORDS)) -> Column:
    """Category of the highest score; first listed wins ties, channel default when all are zero."""
    channel = F.coalesce(as_col(channel), F.lit(""))
    listed = F.array(*[F.lit(k) for k in names])
    place = lambda s: F.get(listed, (F.array_position(s, F.array_max(s)) - 1).cast("int"))
    default = F.coalesce(
        *[F.when(channel == k, F.lit(v)) for k, v in dims.CHANNEL_CATEGORY.items()],
        *[F.when(channel.startswith(k), F.lit(v)) for k, v in dims.CHANNEL_PREFIX_CATEGORY.items()],
        F.lit(dims.DEFAULT_CATEGORY),
    )
    return F.coalesce(bind(scores, lambda s: F.when(F.array_max(s) > 0, place(s))), default)


def keyword_category(low, channel, keywords=None) -> Column:
    """Category with most distinct keywords present in the lower-cased text."""
    keywords = keywords or dims.KEYWORDS
    return category_of(F.array(*[count_terms(low, terms) for terms in keywords.values()]), channel, tuple(keywords))


def term_mask(low, terms) -> Column:
    """One bit per term present; masks of many texts combine with bit_or."""
    low = as_col(low)
    bits = [F.when(low.contains(t), F.lit(1 << i)).otherwise(F.lit(0)) for i, t in enumerate(terms)]
    total = F.lit(0).cast("bigint")
    for bit in bits:
        total = total.bitwiseOR(bit.cast("bigint"))
    return total


def category_lock(low, provisional, patterns=None) -> Column:
    """The one category whose strong patterns match, if it agrees with a valid provisional one."""
    patterns = patterns or dims.LOCK_PATTERNS
    low, given = as_col(low), F.trim(F.coalesce(as_col(provisional), F.lit("")))
    hits = F.array_compact(
        F.array(*[F.when(low.rlike("(?iU)" + "|".join(f"(?:{p})" for p in ps)), F.lit(cat)) for cat, ps in patterns.items()])
    )
    agrees = lambda h: ~given.isin(dims.CATEGORIES) | (given == h[0])
    return bind(hits, lambda h: F.when((F.size(h) == 1) & agrees(h), F.get(h, F.lit(0))))


def importance_of(n_strong, top_rank) -> Column:
    bonus = F.floor(F.greatest(F.lit(0), as_col(top_rank) - 60) / 4)
    terms = F.least(F.lit(24), as_col(n_strong) * 4)
    return F.least(F.greatest(F.lit(45) + bonus + terms, F.lit(35)), F.lit(88)).cast("int")


def provisional_importance(low, top_rank) -> Column:
    return importance_of(count_terms(low, dims.STRONG_TERMS), top_rank)


def alias_tags(low, config: dims.PriorityConfig) -> Column:
    """Watched entities any of whose aliases occur, as array<struct<name,type>> in list order."""
    low = as_col(low)
    seen, hits = set(), []
    for e in config.entities:
        if not e.name or e.name.lower() in seen:
            continue
        seen.add(e.name.lower())
        found = F.lit(False)
        for alias in e.aliases:
            found = found | alias_match(low, alias)
        hits.append(F.when(found, F.struct(F.lit(e.name).alias("name"), F.lit(e.type).alias("type"))))
    if not hits:
        return F.array().cast("array<struct<name:string,type:string>>")
    return F.array_compact(F.array(*hits))


def topic_tags(low, config: dims.PriorityConfig) -> Column:
    """Macro topics with any term present, in topic order."""
    hits = [F.when(contains_any(low, terms), F.lit(tag)) for tag, terms in config.topics.items()]
    return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")
