"""URL column functions over RFC 3986 parts; no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsgrid import dims
from newsgrid.functions.text import as_col, bind

_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _part(c: Column, group: int) -> Column:
    return F.regexp_extract(c, _PARTS, group)


def host(c) -> Column:
    return F.lower(_part(as_col(c), 2))


def path(c) -> Column:
    return _part(as_col(c), 3)


def _decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def _encode(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def query_pairs(c) -> Column:
    """Query string as array<struct<k,v>>, decoded, in order, blank values kept."""
    pieces = F.filter(F.split(_part(as_col(c), 4), "&"), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            _decode(F.substring_index(p, "=", 1)).alias("k"),
            _decode(F.when(p.contains("="), F.regexp_replace(p, "(?s)^[^=]*=", "")).otherwise(F.lit(""))).alias("v"),
        ),
    )


def _encode_pairs(pairs: Column) -> Column:
    return F.array_join(F.transform(pairs, lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&")


def _join(scheme: Column, netloc: Column, url_path: Column, query: Column, fragment: Column) -> Column:
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
        F.when(netloc != "", F.concat(F.lit("//"), netloc)).otherwise(F.lit("")),
        url_path,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(F.lit("")),
    )


def canonical_url(c, drop=tuple(dims.TRACKING_KEYS), prefix: str = dims.TRACKING_PREFIX) -> Column:
    """Lower-case scheme and host, drop the fragment and tracking parameters."""
    keep = lambda p: ~F.lower(p["k"]).startswith(prefix) & ~F.lower(p["k"]).isin(list(drop))

    def canon(u: Column) -> Column:
        query = _encode_pairs(F.filter(query_pairs(u), keep))
        return _join(F.lower(_part(u, 1)), F.lower(_part(u, 2)), _part(u, 3), query, F.lit(""))

    return bind(F.coalesce(as_col(c), F.lit("")), canon)


def unwrap_redirect(c, redirect_host: str, keys=tuple(dims.REDIRECT_KEYS)) -> Column:
    """Target of a search-engine redirect: first listed parameter holding an http(s) URL."""
    c = as_col(c)
    pairs = query_pairs(c)

    def values_of(key: str) -> Column:
        found = F.filter(pairs, lambda p: p["k"] == key)
        return F.transform(found, lambda p: _decode(F.replace(p["v"], F.lit("+"), F.lit("%2B"))))

    targets = F.concat(*[values_of(key) for key in keys])
    links = F.filter(targets, lambda t: t.startswith("http://") | t.startswith("https://"))
    return F.when(host(c).contains(redirect_host), F.coalesce(F.get(links, F.lit(0)), c)).otherwise(c)


def unwrap_archive(c, site: str) -> Column:
    """Original absolute URL behind an archive link, rebuilt on ``site``, query dropped."""
    c = as_col(c)
    inner = F.regexp_extract(c, r"/web/[^/]+/(https?://.+)$", 1)
    full = F.when(inner != "", inner).when(c.startswith("//"), F.concat(F.lit("https:"), c)).when(
        c.startswith("/"), F.concat(F.lit(site), c)
    ).otherwise(c)
    return F.concat(F.lit(site), path(full))


def rewrite_prefix(c, old: str, new: str) -> Column:
    """Move a legacy prefix to its surviving one and drop query and fragment."""
    return F.regexp_replace(F.replace(as_col(c), F.lit(old), F.lit(new)), r"(?s)[?#].*$", "")


def set_page(c, page) -> Column:
    """Set or replace the ``page`` parameter; repeated keys keep first place and last value."""
    c = as_col(c)
    number = as_col(page).cast("string")
    given = query_pairs(c)
    own = F.struct(F.lit("page").alias("k"), number.alias("v"))
    pairs = F.when(F.exists(given, lambda p: p["k"] == "page"), given).otherwise(F.concat(given, F.array(own)))
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))

    def last_value(k: Column) -> Column:
        kept = F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"]
        return F.struct(k.alias("k"), F.when(k == "page", number).otherwise(kept).alias("v"))

    last = F.transform(keys, last_value)
    return _join(F.lower(_part(c, 1)), _part(c, 2), _part(c, 3), _encode_pairs(last), _part(c, 5))


def resolve(base, href) -> Column:
    """Absolute form of a link found on page ``base``."""
    base, href = as_col(base), as_col(href)
    origin = F.concat(_part(base, 1), F.lit("://"), _part(base, 2))
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"/[^/]*$", "/")
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(_part(base, 1), F.lit(":"), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("?") | href.startswith("#"), F.concat(F.regexp_replace(base, r"[?#].*$", ""), href))
        .otherwise(F.concat(folder, href))
    )


def search_url(base: str, query, market: str = "en-US") -> Column:
    return F.concat(F.lit(base + "?q="), _encode(as_col(query)), F.lit("&format=rss&mkt=" + market))
