"""The queries of this subpackage, with SQL where DuckDB can state the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsgrid.llm import arc, filter_audit, hard_negatives, hashing_search, licenses, line_chunks, line_frequency, packing, pfair, pii_crf, secret_links, simhash, toxicity
from newsgrid.llm.common import cut_lineage, fresh_path, table


def op1_line_frequency(spark, sf):
    return line_frequency.line_frequency(table(spark, sf, "documents"))


def op2_multi_index_hashing(spark, sf):
    return hashing_search.nearest(table(spark, sf, "embeddings"))


def op3_line_chunks(spark, sf):
    made = line_chunks.line_chunk_dedup(table(spark, sf, "documents"))
    return made.select("doc_id", F.length("text").cast("long").alias("n_left"), F.sha1("text").alias("text_sha1"))


def op4_arc_to_warc(spark, sf):
    pages = table(spark, sf, "pages").select(
        "page_id", "html", F.concat(F.coalesce("url", F.lit("urn:none")), F.lit("#page="), F.coalesce(F.col("page_id").cast("string"), F.lit(""))).alias("url"),
        F.lit("192.0.2.1").alias("ip"), F.lit("20080430204825").alias("date"),
    )
    folder = fresh_path(spark, "arc")
    odd = F.col("page_id") % 2 != 0
    arc.write_arc(pages.where(F.coalesce(odd, F.lit(False))), f"{folder}/v1", "1")
    arc.write_arc(pages.where(~F.coalesce(odd, F.lit(False))), f"{folder}/v2", "2")
    records = arc.read_arc(spark, f"{folder}/v1").unionByName(arc.read_arc(spark, f"{folder}/v2"))
    page = lambda: F.regexp_extract("url", r"#page=(-?[0-9]*)$", 1).try_cast("long")
    arc.write_warc(arc.to_warc(records.withColumn("page_id", page()), "page_id"), f"{folder}/warc")
    read = cut_lineage(arc.read_warc(spark, f"{folder}/warc").withColumn("page_id", page()).drop("payload"))
    heads = read.where("record_type = 'response' and payload_bytes >= 1000").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")).distinct()  # rows that share a page id share its record id
    return read.join(heads, "refers_to_id", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_pfair_mixing(spark, sf):
    return pfair.mix(table(spark, sf, "documents")).select("doc_id", "source", "queue", "block", "slot", "in_block")


def op6_simhash(spark, sf):
    made = simhash.near_duplicates(table(spark, sf, "documents"))
    return made.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), tokenizer_path())


def op8_license_rules(spark, sf):
    made = licenses.scan_licenses(table(spark, sf, "documents").select("doc_id", "text"))
    at = F.flatten(F.transform("base", lambda x: x["at"]))
    joined = lambda c: F.array_join(c, ",")
    return made.select(
        "doc_id", "n_words", F.size(at).cast("long").alias("n_base"), F.array_min(at).cast("long").alias("first_word"), F.array_max(at).cast("long").alias("last_word"),
        joined("base_labels").alias("base_labels"), joined("labels").alias("labels"), "score",
    )


def op9_skip_chain_crf(spark, sf):
    made = pii_crf.find_pii(table(spark, sf, "documents"))
    told = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    counted = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    counts = [counted(k).alias(f"n_{k}") for k in pii_crf.KINDS]
    return made.select("doc_id", *counts, F.sha2(told("base"), 256).alias("base_sha256"), told("spans").alias("spans"))


def op10_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    lexicon = toxicity.learn_lexicon(docs, table(spark, sf, "labels"))
    made = toxicity.score_toxicity(docs.select("doc_id", "text"), lexicon)
    held = F.coalesce(toxicity.held_out(), F.lit(False))
    return made.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_filter_audit(spark, sf):
    return filter_audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op12_hard_negatives(spark, sf):
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(table(spark, sf, "embeddings"), F.col("id") % 100 == 0, moved)


def op13_secret_links(spark, sf):
    made = secret_links.find_secrets(table(spark, sf, "documents"))
    told = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    counts = [F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}") for k in secret_links.KINDS]  # noqa: B023
    return made.select("doc_id", *counts, F.sha2(told("base"), 256).alias("base_sha256"), told("spans").alias("spans"))


NAMES = [op1_line_frequency, op2_multi_index_hashing, op3_line_chunks, op4_arc_to_warc, op5_pfair_mixing, op6_simhash, op7_packing, op8_license_rules, op9_skip_chain_crf, op10_toxicity, op11_filter_audit, op12_hard_negatives, op13_secret_links]
QUERIES = {f.__name__: f for f in NAMES}

ORACLE = {
    "op4_arc_to_warc": """
        with p as (select page_id, coalesce(html, '') h, octet_length(encode(coalesce(html, ''))) n from pages),
        d as (select page_id, n, sha1(h) s from p),
        m as (select s, n, max(page_id) head from d where n >= 1000 group by s, n)
        select page_id, d.n::bigint payload_bytes, d.s payload_digest,
               case when head is not null and head <> page_id then 'revisit' else 'response' end record_type,
               case when head <> page_id then head end refers_to
        from d left join m on d.s = m.s and d.n = m.n""",
    "op11_filter_audit": r"""
        with d as (select doc_id, coalesce(source, '') part, coalesce(text, '') t from documents),
        w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') words, coalesce(doc_id > min(doc_id) over (partition by t), false) copy from d),
        m as (select doc_id, part,
                case when len(words) < 200 then 1 else 0 end + case when 100 * len(list_distinct(words)) < 50 * len(words) then 2 else 0 end
                + case when 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t) then 4 else 0 end
                + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end + case when copy then 16 else 0 end mask from w),
        l as (select doc_id, max(case when quality = 1 then 1 else 0 end) good, max(case when toxic = 1 then 1 else 0 end) toxic from labels group by doc_id),
        c as (select part, mask, count(*) n, sum(coalesce(good, 0)) g, sum(coalesce(toxic, 0)) x from m left join l using (doc_id) group by part, mask),
        f(name, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
        o as (select a.name || b.name || c.name || d.name || e.name filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] bits
              from f a, f b, f c, f d, f e where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and a.bit | b.bit | c.bit | d.bit | e.bit = 31),
        s as (select filter_order, step, bits[step] bit, coalesce(list_sum(bits[:step - 1]), 0)::int before from o, range(1, 6) r(step)),
        t as (select part, filter_order, step, bit, sum(case when mask & (before | bit) = 0 then n else 0 end) kept,
                sum(case when mask & before = 0 and mask & bit <> 0 then n else 0 end) removed,
                sum(case when mask & before <> 0 and mask & bit <> 0 then n else 0 end) redundant,
                sum(case when mask = bit then n else 0 end) unique_fails,
                sum(case when mask & before = 0 and mask & bit <> 0 then g else 0 end) good_lost,
                sum(case when mask & before = 0 and mask & bit <> 0 then x else 0 end) toxic_lost
              from c, s group by part, filter_order, step, bit)
        select part, filter_order, step::int step, kept::bigint kept, removed::bigint removed, redundant::bigint redundant, unique_fails::bigint unique_fails,
               good_lost::bigint good_lost, toxic_lost::bigint toxic_lost, (sum(removed) over (partition by part, bit))::bigint shapley from t""",
}
