"""Filter interaction audit: what every order of five filters keeps, removes and costs, per part.

Each document is a cell of a mask with one bit per filter it fails. Documents are counted by (part, mask)
before anything else, so a part has at most 32 weighted cells, whatever its size. Each cell is folded
across the array of all orders with higher-order functions: ``transform`` walks the orders, ``aggregate``
walks the steps of one order and carries whether the cell is still there. A cell gives one weighted
struct per order and step; the cells of a part are merged by elementwise sums.

Failure conditions: A fewer than 200 words; B distinct words below half of the words; C more than 2 %
``[A-Z]`` characters; D any of ``#$%&*|``; E the text of a smaller id, anywhere in the table.

Null text is empty, null source the empty part. A row without id is no one's copy and has no copies by
id, so it never fails E; rows that share their id and text are not each other's copies. Repeated rows count
each. A label row matches by id; an id with several label rows counts as good if any says so. An
empty table has no parts and no rows. Columns beyond doc_id, text and source are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsgrid.llm.common import cut_lineage

FILTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
GAP = r"[\x20\x09-\x0D]+"


def facts(docs: DataFrame) -> DataFrame:
    """(id, part, digest, mask of A to D, n): one narrow row per different document, read from the texts once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    held = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    # One row per text out of a generator: each condition reads the word list that is made once.
    words = F.filter(F.split("text", GAP), lambda w: w != "")
    sized = held.select("id", "part", "text", F.inline(F.array(F.struct(words.alias("words")))))
    n = F.size("words")
    fails = [n < 200, 100 * F.size(F.array_distinct("words")) < 50 * n, 100 * F.length(F.regexp_replace("text", "[^A-Z]+", "")) > 2 * F.length("text"), F.col("text").rlike(r"[#$%&*|]")]
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    return sized.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.cast("int").alias("mask")).groupBy("id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): at most 32 rows a part.

    The first of each text is found by a grouped minimum, which is combined before the shuffle, and met
    again on (digest, id), so a text that a third of all rows share is no hot key.
    """
    told = cut_lineage(facts(docs))
    heads = told.where("id is not null").groupBy("digest").agg(F.min("id").alias("id")).withColumn("head", F.lit(True))
    copies = told.join(heads, ["digest", "id"], "left").withColumn("mask", F.col("mask") + F.when(F.col("id").isNotNull() & F.col("head").isNull(), 16).otherwise(0))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("key")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    # Rows without id match nothing; the digest spreads them over tasks.
    keyed = copies.withColumn("known", F.col("id").isNotNull()).withColumn("key", F.coalesce("id", F.xxhash64("digest")))
    joined = keyed.join(marks.withColumn("known", F.lit(True)), ["key", "known"], "left")
    weight = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    return joined.groupBy("part", "mask").agg(F.sum("n").alias("n"), weight("good").alias("good"), weight("toxic").alias("toxic"))


def order_array() -> Column:
    """All orders, each an array of the bits of its filters in turn."""
    return F.array(*[F.array(*[F.lit(1 << FILTERS.index(f)) for f in order]) for order in permutations(FILTERS)])


def folded(cell: Column, orders: Column) -> Column:
    """One cell's weighted structs, by order and step."""

    def stepped(state: Column, bit: Column) -> Column:
        fails = cell["mask"].bitwiseAND(bit) != 0
        lost = state["there"] & fails
        counted = lambda when, weight="n": F.when(when, cell[weight]).otherwise(F.lit(0).cast("long"))
        made = F.struct(
            counted(state["there"] & ~fails).alias("kept"), counted(lost).alias("removed"), counted(fails & ~state["there"]).alias("redundant"),
            counted(cell["mask"] == bit).alias("unique_fails"), counted(lost, "good").alias("good_lost"), counted(lost, "toxic").alias("toxic_lost"),
        )
        return F.struct((state["there"] & ~fails).alias("there"), F.concat(state["steps"], F.array(made)).alias("steps"))

    start = F.struct(F.lit(True).alias("there"), F.array().cast(STEPS).alias("steps"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(order, start, stepped, lambda s: s["steps"])))


STEPS = f"array<struct<{','.join(f'{c}:bigint' for c in COUNTS)}>>"


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """600 rows a part: part, filter_order, step, the counts, and the filter's removals over all orders (shapley)."""
    spark = docs.sparkSession
    orders = spark.range(1).select(order_array().alias("orders"), F.array(*[F.lit("".join(o)) for o in permutations(FILTERS)]).alias("names"))
    cells = mask_cells(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    held = cells.join(F.broadcast(orders))  # one row: the orders
    zero = F.transform(F.flatten(F.col("orders")), lambda _: F.struct(*[F.lit(0).cast("long").alias(c) for c in COUNTS]))
    added = lambda a, b: F.struct(*[(a[c] + b[c]).alias(c) for c in COUNTS])
    merged = held.withColumn("sums", F.aggregate("cells", zero, lambda total, cell: F.zip_with(total, folded(cell, F.col("orders")), added)))
    bits = F.flatten(F.col("orders"))
    told = merged.select("part", "names", F.inline(F.array(F.struct(F.col("sums").alias("sums"), bits.alias("bits")))))
    share = lambda bit: F.aggregate(F.zip_with("sums", "bits", lambda s, b: F.when(b == bit, s["removed"]).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, x: a + x)
    shares = F.create_map(*[x for i in range(len(FILTERS)) for x in (F.lit(1 << i), share(F.lit(1 << i)))])
    rows = told.withColumn("shares", shares).select("part", "names", "bits", "shares", F.posexplode("sums").alias("at", "s"))
    place = lambda c: F.element_at(c, (F.col("at") + 1).cast("int"))
    return rows.select(
        "part", F.element_at("names", (F.floor(F.col("at") / 5) + 1).cast("int")).alias("filter_order"), (F.col("at") % 5 + 1).cast("int").alias("step"),
        *[F.col(f"s.{c}").alias(c) for c in COUNTS], F.element_at("shares", place("bits")).alias("shapley"),
    )
