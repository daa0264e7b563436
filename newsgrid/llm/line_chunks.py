"""Line dedup by content-defined chunks of lines, in DataFrame functions only.

A chunk closes where the rolling hash over the last two lines is smaller than at the lines beside it,
so every chunk within a passage has two lines or more and an inserted line moves only the boundaries
beside it; a line of ``long_words`` words is a chunk of its own. Of equal chunks with at
least two lines (or that many words) the one in the first row stays and the others go, once their
text has been compared.

Runs need no boundary: from each line on, and up to each line, the fewest lines that reach ``long_words``
words, and a whole text of fewer words on two lines or more. Every line of a repeated passage of that many
words lies in such a run of the passage. A run that overlaps its first place in its own row stays. Places
that repeat one row at one distance are joined before their texts are compared.
 Null text stays null; a row whose text had words and keeps none goes. Rows
with the same id and text are one row here: neither is a copy of the other. Extra columns
pass; names with a leading underscore are reserved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsgrid.functions.frames import staged
from newsgrid.llm.common import cut_lineage, salted

SALTS = 32  # tasks in which the places of one chunk, hashes only, meet its count


def line_ends() -> Column:
    """Positions of the last line of each chunk, from rolled hashes ``_r`` and wide-line marks ``_w``."""
    at = F.sequence(F.lit(1), F.size("_r"))

    def closes(i: Column) -> Column:
        here, before, after = F.element_at("_r", i), F.try_element_at("_r", F.greatest(i - 1, F.lit(1))), F.try_element_at("_r", i + 1)
        least = (here < before) & (here <= after)
        return (i == F.size("_r")) | F.coalesce(least, F.lit(False)) | F.element_at("_w", i) | F.coalesce(F.try_element_at("_w", i + 1), F.lit(False))

    return F.filter(at, closes)


def runs(long_words: int) -> Column:
    """(first, n) of the shortest runs of lines with ``long_words`` words, from ``_wl``: the line of each word, and ``_s``: each line's first word."""
    words, need = F.size("_wl"), F.lit(long_words)
    line = lambda p: F.element_at("_wl", p)
    span = lambda p, q: F.struct(line(p).alias("first"), (line(q) - line(p) + 1).alias("n"))
    onward = F.transform(F.filter("_s", lambda p: p + need - 1 <= words), lambda p: span(p, p + need - 1))
    ends = F.transform("_s", lambda p, k: F.coalesce(F.try_element_at("_s", k + 2) - 1, words))
    back = F.transform(F.filter(ends, lambda q: q >= need), lambda q: span(q - need + 1, q))
    whole = F.array(F.struct(F.lit(1).alias("first"), F.size("_lines").alias("n")))
    return F.when((words < need) & (F.size("_s") > 1), whole).otherwise(F.filter(F.array_distinct(F.concat(onward, back)), lambda c: c["n"] > 1))


def chunked(rows: DataFrame, long_words: int) -> DataFrame:
    """Adds ``_chunks``: (first line, lines, hash, size) of the chunks and runs that may be removed."""
    marked = staged(rows, {"_lines": F.split(F.coalesce("text", F.lit("")), "\n")})
    hashes = F.transform("_lines", lambda x: F.xxhash64(F.trim(x)))
    words = F.transform("_lines", lambda x: F.when(F.trim(x) == "", F.lit(0)).otherwise(F.size(F.split(F.trim(x), " +"))))
    marked = staged(marked, {"_h": hashes, "_n": words, "_g": F.transform("_lines", lambda x: F.xxhash64(x))})
    marked = staged(marked, {"_w": F.transform("_n", lambda n: n >= long_words), "_wl": F.flatten(F.transform("_n", lambda n, i: F.array_repeat(i + 1, n)))})
    starts = F.filter(F.sequence(F.lit(1), F.size("_wl")), lambda p: (p == 1) | (F.element_at("_wl", p) != F.element_at("_wl", F.greatest(p - 1, F.lit(1)))))
    marked = staged(marked, {"_s": F.when(F.size("_wl") > 0, starts).otherwise(F.array().cast("array<int>"))})
    rolled = F.transform("_h", lambda h, i: F.xxhash64(h, F.try_element_at("_h", F.greatest(i, F.lit(1)))))
    marked = staged(marked, {"_r": rolled, "_runs": runs(long_words)})
    marked = staged(marked, {"_ends": line_ends()})
    first = lambda k: F.when(k == 0, F.lit(1)).otherwise(F.element_at("_ends", F.greatest(k, F.lit(1))) + 1)
    made = F.transform("_ends", lambda e, k: F.struct(first(k).alias("first"), (e - first(k) + 1).alias("n")))
    full = F.filter(made, lambda c: (F.size(F.filter(F.slice("_n", c["first"], c["n"]), lambda n: n > 0)) >= 2) | F.exists(F.slice("_w", c["first"], c["n"]), lambda w: w))
    hashed = lambda c: F.struct(c["first"].alias("first"), c["n"].alias("n"), F.xxhash64(F.slice("_g", c["first"], c["n"])).alias("hash"))
    told = F.transform(F.array_distinct(F.concat(full, "_runs")), hashed)
    return staged(marked, {"_chunks": told}).drop("_h", "_n", "_g", "_w", "_wl", "_s", "_r", "_runs", "_ends")


def repeated_chunks(rows: DataFrame, long_words: int = 50, a_salt: int = 256) -> DataFrame:
    """(_key, first, n) of the lines that repeat earlier ones, byte for byte.

    The places of one text meet it in one task per ``a_salt`` of them.
    """
    pieces = chunked(rows.select("doc_id", "_key", "text"), long_words).select("doc_id", "_key", F.explode("_chunks").alias("c"))
    told = cut_lineage(pieces.select("doc_id", "_key", "c.first", "c.n", "c.hash").distinct())
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_key", "first")
    heads = told.groupBy("hash", "n").agg(F.min(order).alias("head"), F.count(F.lit(1)).alias("n_places")).where("n_places > 1")
    heads = heads.select("hash", "n", F.col("head._key").alias("to_key"), F.col("head.first").alias("to_first"))
    spread = told.withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(SALTS)).cast("int"))
    places = spread.join(salted(heads, SALTS), ["hash", "n", "_salt"]).where("_key <> to_key or first >= to_first + n")
    ahead = Window.partitionBy("_key", "to_key", "apart").orderBy("first", "n")
    places = places.select("_key", "to_key", (F.col("first") - F.col("to_first")).alias("apart"), "first", "n")
    upto = F.max(F.col("first") + F.col("n")).over(ahead.rowsBetween(Window.unboundedPreceding, -1))
    joined = places.withColumn("_new", (upto.isNull() | (F.col("first") > upto)).cast("int")).withColumn("_part", F.sum("_new").over(ahead.rowsBetween(Window.unboundedPreceding, 0)))
    whole = joined.groupBy("_key", "to_key", "apart", "_part").agg(F.min("first").alias("first"), (F.max(F.col("first") + F.col("n")) - F.min("first")).alias("n"))
    whole = cut_lineage(whole.select("_key", "first", "n", "to_key", (F.col("first") - F.col("apart")).alias("to_first")))
    models = whole.groupBy("to_key", "to_first", "n").agg(F.ceil(F.count(F.lit(1)) / a_salt).cast("int").alias("salts"))
    wanted = whole.select("_key", "first", "n").unionByName(models.select(F.col("to_key").alias("_key"), F.col("to_first").alias("first"), "n"))
    held = wanted.groupBy("_key").agg(F.collect_set(F.struct("first", "n")).alias("places"))
    line = F.split(F.coalesce("text", F.lit("")), "\n")
    texts = rows.select("_key", "text").dropDuplicates(["_key"]).join(held, "_key").select("_key", line.alias("_lines"), F.explode("places").alias("p"))
    texts = cut_lineage(texts.select("_key", "p.*", F.array_join(F.slice("_lines", F.col("p.first"), F.col("p.n")), "\n").alias("chunk")))
    model = texts.select(F.col("_key").alias("to_key"), F.col("first").alias("to_first"), "n", F.col("chunk").alias("model"))
    model = models.join(model, ["to_key", "to_first", "n"]).select("to_key", "to_first", "n", "model", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    spread = whole.withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(SALTS)).cast("int"))
    others = spread.join(salted(models, SALTS), ["to_key", "to_first", "n", "_salt"]).drop("_salt").withColumn("salt", F.pmod(F.xxhash64("_key"), "salts").cast("int")).drop("salts")
    others = others.join(texts, ["_key", "first", "n"]).join(model, ["to_key", "to_first", "n", "salt"])
    return others.where(F.col("chunk") == F.col("model")).select("_key", "first", "n")


def line_chunk_dedup(docs: DataFrame, long_words: int = 50) -> DataFrame:
    """``docs`` without repeated chunks, all columns kept; ``n_chars`` follows the text where it exists."""
    names = docs.columns
    rows = docs.withColumn("_key", F.concat_ws("-", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.hex(F.xxhash64("text"))))
    gone = repeated_chunks(rows, long_words).groupBy("_key").agg(F.collect_set(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("_gone"))
    joined = rows.join(gone.withColumn("_gone", F.array_distinct(F.flatten("_gone"))), "_key", "left")
    lines = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("_gone", i + 1))
    made = joined.withColumn("_kept", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(lines, "\n")))
    made = made.where(F.col("_gone").isNull() | F.col("_kept").rlike(r"\S"))
    out = made.withColumn("text", F.col("_kept"))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("_gone").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*names)
