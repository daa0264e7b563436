"""Queries over the column functions: text, URL, date, number and identifier operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsgrid import dims, views
from newsgrid.functions import dates, ids, numbers, text, urls
from newsgrid.plans.registry import query
from newsgrid.views import WITH_NEWS, news_items, table

DUCK_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def d_clean(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{DUCK_WS}', ' ', 'g'))"


def d_norm(c: str) -> str:
    return f"trim(regexp_replace(lower({d_clean(c)}), '[^a-z0-9]+', ' ', 'g'))"


def d_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def d_canonical(u: str) -> str:
    scheme = f"lower(regexp_extract({u}, '^([a-zA-Z]+)://', 1))"
    host = f"lower(regexp_extract({u}, '^[a-zA-Z]+://([^/?#]*)', 1))"
    path = f"regexp_extract({u}, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1)"
    qs = f"regexp_extract({u}, '^[^?#]*\\?([^#]*)', 1)"
    keep = (
        f"array_to_string([p for p in string_split({qs}, '&') if p <> '' and not starts_with(lower(p), 'utm_') "
        f"and lower(split_part(p, '=', 1)) not in {d_list(dims.TRACKING_KEYS)}], '&')"
    )
    return f"({scheme} || '://' || {host} || {path} || CASE WHEN {keep} <> '' THEN '?' || {keep} ELSE '' END)"


def d_iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')"


D_TOKENS = (
    f"list_sort(list_distinct([w for w in string_split({d_norm('title')}, ' ') "
    f"if length(w) > 1 and w not in {d_list(dims.STOP_WORDS)}]))"
)


@query("ws_clean", f"SELECT doc_id, {d_clean('text')} AS cleaned FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.ws_clean("text").alias("cleaned"))


@query("title_norm", f"SELECT doc_id, {d_norm('text')} AS normed FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.title_norm("text").alias("normed"))


@query("token_set", f"{WITH_NEWS} SELECT doc_id, array_to_string({D_TOKENS}, ' ') AS tokens FROM news_items")
def _(spark, sf):
    return news_items(spark, sf).select("doc_id", F.array_join(text.token_set("title"), " ").alias("tokens"))


_UNESC = "{x}"
for _name, _char in [("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", " "), ("&#39;", "''"), ("&amp;", "&")]:
    _UNESC = f"replace({_UNESC}, '{_name}', '{_char}')"


def d_unescape(c: str) -> str:
    return _UNESC.replace("{x}", c)


def d_strip_tags(c: str) -> str:
    hidden = f"regexp_replace({c}, '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<!--.*?-->', ' ', 'g')"
    return d_clean(d_unescape(f"regexp_replace({hidden}, '<[!/?]?[A-Za-z][^>]*>', ' ', 'g')"))


@query("strip_html", f"SELECT page_id, {d_strip_tags(d_unescape('html'))} AS plain FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.strip_html("html").alias("plain"))


@query(
    "truncate_ellipsis",
    f"""WITH c AS (SELECT doc_id, {d_clean('text')} AS v FROM documents)
    SELECT doc_id, CASE WHEN length(v) <= 600 THEN v ELSE rtrim(substr(v, 1, 599)) || '…' END AS cut FROM c""",
)
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.truncate("text", 600).alias("cut"))


@query(
    "canonical_url",
    f"""{WITH_NEWS} SELECT 'n' || CAST(doc_id AS VARCHAR) AS k, {d_canonical('url')} AS canon FROM news_items
    UNION ALL SELECT 'p' || CAST(page_id AS VARCHAR), {d_canonical('url')} FROM pages""",
)
def _(spark, sf):
    news = news_items(spark, sf).select(F.concat(F.lit("n"), F.col("doc_id").cast("string")).alias("k"), "url")
    pages = table(spark, sf, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("k"), "url")
    return news.unionByName(pages).select("k", urls.canonical_url("url").alias("canon"))


@query(
    "unwrap_redirect_url",
    """SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url WHEN page_id % 3 = 1 THEN split_part(url, '?', 1)
      ELSE 'https://other.example.com/r?url=x' END AS target FROM (SELECT page_id, replace(url, '#top', '') AS url FROM pages)""",
)
def _(spark, sf):
    plain = F.replace("url", F.lit("#top"), F.lit(""))
    wrapped = (
        F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://www.Bing.com/news/apiclick.aspx?u=rel&url="), F.url_encode(plain), F.lit("&c=1")))
        .when(F.col("page_id") % 3 == 1, F.concat(F.lit("http://bing.com/ck?r="), F.substring_index(plain, "?", 1), F.lit("&x=")))
        .otherwise(F.lit("https://other.example.com/r?url=x"))
    )
    return table(spark, sf, "pages").select("page_id", urls.unwrap_redirect(wrapped, "bing.com").alias("target"))


@query(
    "url_prefix_rewrite",
    """SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '^https://blog\\.', 'https://www.') AS moved FROM pages""",
)
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.rewrite_prefix("url", "https://blog.", "https://www.").alias("moved"))


@query(
    "url_set_page",
    """WITH s AS (SELECT page_id, split_part(url, '#', 1) AS u, CASE WHEN contains(url, '#') THEN '#' || split_part(url, '#', 2) ELSE '' END AS f,
        CAST(page_id + 1 AS VARCHAR) AS n FROM pages)
    SELECT page_id, CASE WHEN contains(u, 'page=') THEN regexp_replace(u, 'page=[0-9]+', 'page=' || n)
       WHEN contains(u, '?') THEN u || '&page=' || n ELSE u || '?page=' || n END || f AS paged FROM s""",
)
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.set_page("url", F.col("page_id") + 1).alias("paged"))


@query(
    "parse_date_multi",
    """SELECT event_id, strftime(CASE event_id % 7 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts) - INTERVAL 2 HOUR
       WHEN 6 THEN NULL ELSE date_trunc('day', ts) END, '%Y-%m-%dT%H:%M:%SZ') AS parsed FROM events""",
)
def _(spark, sf):
    fmt = lambda f: F.date_format("ts", f)
    n = F.col("event_id") % 7
    day = fmt("d")
    written = (
        F.when(n == 0, fmt("EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
        .when(n == 1, fmt("dd MMM yyyy HH:mm:ss '+0200'"))
        .when(n == 2, F.concat(F.lit("<b>posted on</b> "), day, F.lit("th "), fmt("MMMM yyyy"), F.lit(" by staff")))
        .when(n == 3, fmt("yyyy-MM-dd"))
        .when(n == 4, fmt("dd MMM yyyy"))
        .when(n == 5, fmt("MMMM d, yyyy"))
        .otherwise(F.lit("no date here"))
    )
    src = table(spark, sf, "events").select("event_id", written.alias("written"))
    return src.select("event_id", dates.format_iso_utc(dates.parse_date_multi("written")).alias("parsed"))


@query(
    "parse_iso_utc",
    """SELECT event_id, strftime(CASE event_id % 5 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts) - INTERVAL 330 MINUTE
       WHEN 2 THEN date_trunc('second', ts) WHEN 3 THEN date_trunc('day', ts) ELSE NULL END, '%Y-%m-%dT%H:%M:%SZ') AS parsed FROM events""",
)
def _(spark, sf):
    fmt = lambda f: F.date_format("ts", f)
    n = F.col("event_id") % 5
    written = (
        F.when(n == 0, fmt("yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(n == 1, fmt("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+05:30'"))
        .when(n == 2, fmt("yyyy-MM-dd HH:mm:ss"))
        .when(n == 3, fmt("yyyy-MM-dd"))
        .otherwise(fmt("dd/MM/yyyy"))
    )
    src = table(spark, sf, "events").select("event_id", written.alias("written"))
    return src.select("event_id", dates.format_iso_utc(dates.parse_iso_utc("written")).alias("parsed"))


@query("format_iso_utc", f"SELECT event_id, {d_iso('ts')} AS iso FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", dates.format_iso_utc("ts").alias("iso"))


@query(
    "parse_number_bounded",
    """WITH n AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 4 = 3 THEN -l_extendedprice ELSE l_extendedprice END AS v FROM lineitem)
    SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 4 <> 2 AND v BETWEEN 1000 AND 50000 THEN v END AS price FROM n""",
)
def _(spark, sf):
    v = F.when(F.col("l_linenumber") % 4 == 3, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    written = F.when(F.col("l_linenumber") % 4 == 2, F.lit("n/a")).otherwise(
        F.concat(F.lit("US$ "), F.regexp_replace(F.format_number(v, 2), r"^-", "-"), F.lit(" per unit (2 lots)"))
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", numbers.parse_number(written, 1000, 50000).alias("price")
    )


@query(
    "clamp_int",
    """SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 55 ELSE CAST(least(greatest(round_even(value, 0), 3), 40) AS INT) END AS score FROM events""",
)
def _(spark, sf):
    raw = F.when(F.col("event_id") % 9 == 0, F.lit("bad")).otherwise(F.col("value").cast("string"))
    score = F.when(F.col("event_id") % 9 == 0, numbers.clamp_int(raw, 3, 100, 55)).otherwise(numbers.clamp_int(raw, 3, 40, 55))
    return table(spark, sf, "events").select("event_id", score.alias("score"))


@query(
    "record_id",
    f"""{WITH_NEWS} SELECT doc_id, substr(sha256(CASE WHEN doc_id % 5 = 0 THEN {d_norm('title')} || '|' || coalesce({d_iso('published_at')}, '') || '|' || source
      ELSE {d_canonical('url')} END), 1, 24) AS rid FROM news_items""",
)
def _(spark, sf):
    url = F.when(F.col("doc_id") % 5 == 0, F.lit("")).otherwise(F.col("url"))
    return news_items(spark, sf).select(
        "doc_id", ids.record_id(url, F.col("title"), dates.format_iso_utc("published_at"), F.col("source")).alias("rid")
    )


@query(
    "fallback_rid",
    f"{WITH_NEWS} SELECT doc_id, substr(sha1({d_norm('title')} || '|' || {d_clean('url')}), 1, 24) AS rid FROM news_items",
)
def _(spark, sf):
    return news_items(spark, sf).select("doc_id", ids.fallback_rid("title", "url").alias("rid"))


@query(
    "story_id",
    f"""{WITH_NEWS} SELECT doc_id, substr(sha1(CASE WHEN doc_id % 4 = 0 THEN {d_norm('title')} || '|' || coalesce(strftime(published_at, '%Y-%m-%d'), '')
      ELSE array_to_string(list_sort([id, 'r1', 'r9']), '|') END), 1, 18) AS sid FROM news_items""",
)
def _(spark, sf):
    raw = F.when(F.col("doc_id") % 4 != 0, F.array(F.col("id"), F.lit("r9"), F.lit("r1")))
    return news_items(spark, sf).select(
        "doc_id", ids.story_id(raw, F.col("title"), dates.format_iso_utc("published_at")).alias("sid")
    )


def d_json_quote(c: str) -> str:
    return f"""'"' || replace(replace({c}, '\\', '\\\\'), '"', '\\"') || '"'"""


def d_fingerprint(category: str, title="title", region="region_raw", entities="entities_text", raw="[id]", names="[source]", links="[url]") -> str:
    ents = f"list_sort([{d_clean('e')} for e in string_split({entities}, '|') if e <> ''])"
    jl = lambda xs: f"'[' || coalesce(array_to_string([{d_json_quote('q')} for q in {xs}], ', '), '') || ']'"
    srcs = f"list_sort([{d_clean(names + '[i]')} || '|' || {d_clean(links + '[i]')} for i in range(1, len({names}) + 1)])"
    return (
        f"substr(sha1('{{\"category\": ' || {d_json_quote(d_clean(category))} || ', \"entities\": ' || {jl(ents)} || ', \"raw_ids\": ' || {jl(f'list_sort({raw})')} "
        f"|| ', \"region\": ' || {d_json_quote(d_clean(region))} || ', \"sources\": ' || {jl(srcs)} || ', \"title\": ' || {d_json_quote(d_clean(title))} || '}}'), 1, 20)"
    )


@query(
    "content_fingerprint",
    f"{WITH_NEWS} SELECT doc_id, {d_fingerprint('lang')} AS fp FROM news_items",
)
def _(spark, sf):
    return news_items(spark, sf).select(
        "doc_id",
        ids.content_fingerprint("title", "lang", "region_raw", "entities", F.array("id"), F.array("source"), F.array("url")).alias("fp"),
    )


@query("month_end", "SELECT o_orderkey, CAST(last_day(o_orderdate) AS DATE) AS last FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.month_end(F.year("o_orderdate"), F.month("o_orderdate")).alias("last")
    )


@query(
    "period_bounds",
    "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS period_start, CAST(last_day(o_orderdate) AS DATE) AS period_end FROM orders",
)
def _(spark, sf):
    y, m = F.year("o_orderdate"), F.month("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.month_start(y, m).alias("period_start"), dates.month_end(y, m).alias("period_end")
    )


@query(
    "infer_year",
    """SELECT o_orderkey, CAST(CASE WHEN o_custkey % 12 + 1 > month(o_orderdate) THEN year(o_orderdate) - 1 ELSE year(o_orderdate) END AS INT) AS y FROM orders""",
)
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.infer_year(F.col("o_custkey") % 12 + 1, F.col("o_orderdate")).alias("y")
    )


@query(
    "epoch_to_date",
    "SELECT event_id, CAST(ts AS DATE) AS from_ms, CAST(ts AS DATE) AS from_s FROM events",
)
def _(spark, sf):
    s = dates.seconds_between(F.col("ts"), dates.as_of_lit("1970-01-01 00:00:00"))
    return table(spark, sf, "events").select(
        "event_id", dates.epoch_ms_date(s * 1000 + 7).alias("from_ms"), dates.epoch_s_date(s).alias("from_s")
    )


@query(
    "local_time_render",
    "SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M') AS shanghai, strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M') AS new_york FROM events",
)
def _(spark, sf):
    show = lambda z: F.date_format(dates.local_time("ts", z), "yyyy-MM-dd HH:mm")
    return table(spark, sf, "events").select(
        "event_id", show("Asia/Shanghai").alias("shanghai"), show("America/New_York").alias("new_york")
    )


@query(
    "search_url_build",
    """SELECT page_id, 'https://search.example.com/news?q=' || replace(replace(replace(url, ':', '%3A'), '/', '%2F'), '?', '%3F') || '&format=rss&mkt=en-US' AS u
    FROM (SELECT page_id, replace(replace(replace(replace(url, '%', '%25'), '#', '%23'), '&', '%26'), '=', '%3D') AS url FROM pages)""",
)
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.search_url("https://search.example.com/news", "url").alias("u"))


@query(
    "article_date_extract",
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN CAST(o_orderdate AS DATE)
      WHEN 2 THEN CAST(strftime(o_orderdate, '%Y-%m-15') AS DATE) ELSE NULL END AS d,
      CASE WHEN year(o_orderdate) BETWEEN 2000 AND 2001 THEN CAST(o_orderdate AS DATE) END AS numeric_d
    FROM (SELECT o_orderkey, o_orderdate + INTERVAL 7 YEAR AS shifted, o_orderdate FROM orders) WHERE year(o_orderdate) >= 2000""",
)
def _(spark, sf):
    src = table(spark, sf, "orders").filter(F.year("o_orderdate") >= 2000)
    n = F.col("o_orderkey") % 4
    fmt = lambda f: F.date_format("o_orderdate", f)
    body = F.when(n == 0, F.concat(F.lit("Tokyo "), fmt("MMM dd,yyyy"), F.lit(" - notice"))).when(
        n == 1, F.concat(F.lit("On "), fmt("MMMM d, yyyy"), F.lit(" the carrier"))
    ).otherwise(F.lit("undated notice"))
    link = F.when(n == 2, F.concat(F.lit("https://x.example/en/release/"), fmt("yyyyMM"), F.lit("/004.html"))).otherwise(F.lit("https://x.example/"))
    page = F.concat(F.lit("updated 2000.99.01 "), fmt("yyyy/M/d"), F.lit(" end"))
    return src.select(
        "o_orderkey", dates.article_date(body, link).alias("d"), dates.page_date(page, 2000, 2001).alias("numeric_d")
    )


@query(
    "scoring_text",
    f"""{WITH_NEWS} SELECT doc_id, array_to_string([x for x in list_concat([{d_clean('title')}, 'Engines & MRO', {d_clean('region_raw')}],
      string_split(entities_text, '|'), [{d_clean('summary')}]) if x <> ''], ' | ') AS scoring FROM news_items""",
)
def _(spark, sf):
    return news_items(spark, sf).select(
        "doc_id",
        text.scoring_text("title", F.lit("Engines & MRO"), "region_raw", "entities", F.array(text.ws_clean("summary"))).alias("scoring"),
    )


@query(
    "search_text",
    f"""{WITH_NEWS} SELECT doc_id, lower(array_to_string(list_concat([title, summary, ''], string_split(CASE WHEN entities_text = '' THEN 'Air China' ELSE entities_text || '|Air China' END, '|'), ['A320']), ' ')) AS hay FROM news_items""",
)
def _(spark, sf):
    return news_items(spark, sf).select(
        "doc_id",
        text.search_text("title", "summary", F.lit(None).cast("string"), "entities", F.array(F.lit("Air China")), F.array(F.lit("A320")), F.lit(None).cast("array<string>")).alias("hay"),
    )


@query(
    "quote_status_map",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN 'FRESH' WHEN event_type = 'error' THEN 'UNAVAILABLE' ELSE 'STALE' END AS quote_status,
      CASE WHEN event_type = 'view' THEN 'LIVE' ELSE 'STALE' END AS series_status FROM events""",
)
def _(spark, sf):
    from newsgrid.operators.series import quote_status, series_status

    state = F.when(F.col("event_type") == "view", F.lit("Fresh")).when(F.col("event_type") == "error", F.lit("unavailable")).otherwise(F.lit("delayed"))
    status = quote_status(state)
    return table(spark, sf, "events").select("event_id", status.alias("quote_status"), series_status(status, ["FRESH", "REALTIME"]).alias("series_status"))


@query(
    "age_since",
    f"""{WITH_NEWS} SELECT doc_id, CASE WHEN s IS NOT NULL THEN round(greatest(0, s / 3600.0), 4) END AS age_hours, CASE WHEN s IS NOT NULL THEN round(greatest(0, s / 86400.0), 4) END AS age_days
      FROM (SELECT doc_id, date_diff('second', published_at, TIMESTAMP '2024-03-15 00:00:00') AS s FROM news_items)""",
)
def _(spark, sf):
    now = dates.as_of_lit("2024-03-15 00:00:00")
    return news_items(spark, sf).select(
        "doc_id",
        F.round(dates.age(F.col("published_at"), now, 3600), 4).alias("age_hours"),
        F.round(dates.age(F.col("published_at"), now, 86400), 4).alias("age_days"),
    )


_D_KEY = r"regexp_replace(upper(e), '[\s\-_/().]', '', 'g')"


@query(
    "model_code_key",
    f"""{WITH_NEWS}, x AS (SELECT doc_id, unnest(string_split(entities_text, '|')) AS e FROM news_items)
    SELECT doc_id, e AS entity, {_D_KEY} AS key, regexp_matches({_D_KEY}, '{text.MODEL_KEY_PATTERN}') AS is_model FROM x WHERE e <> ''""",
)
def _(spark, sf):
    return (
        news_items(spark, sf)
        .select("doc_id", F.explode("entities").alias("entity"))
        .select("doc_id", "entity", text.model_key("entity").alias("key"), text.is_model_code("entity").alias("is_model"))
    )


@query(
    "token_jaccard",
    f"""{WITH_NEWS}, t AS (SELECT doc_id, {D_TOKENS} AS a, list_sort(list_distinct([w for w in string_split({d_norm("substr(summary, 1, length(title) + 60)")}, ' ')
        if length(w) > 1 and w not in {d_list(dims.STOP_WORDS)}])) AS b FROM news_items)
    SELECT doc_id, round(CASE WHEN len(a) > 0 AND len(b) > 0 THEN len(list_intersect(a, b)) / CAST(len(list_distinct(list_concat(a, b))) AS DOUBLE) ELSE 0 END, 6) AS jac FROM t""",
)
def _(spark, sf):
    other = F.substr(F.col("summary"), F.lit(1), F.length("title") + 60)
    t = news_items(spark, sf).select("doc_id", text.token_set("title").alias("a"), text.token_set(other).alias("b"))
    return t.select("doc_id", F.round(text.token_jaccard("a", "b"), 6).alias("jac"))
