"""Reconciliation of price observations of different trust into one series per instrument.

Merged tables are unique per (series, date), so a per-series window is bounded by the calendar;
anything windowed before that uniqueness holds goes through ``previous_value`` or ``moving_conflicts``, which
cut a key's rows into ranges of equal size and carry one outcome across each boundary.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsgrid.functions.dates import as_of_lit
from newsgrid.functions.numbers import pct_change
from newsgrid.functions.text import as_col
from newsgrid.operators.dedupe import first_per_key
from newsgrid.session import cut_lineage

KEY = ("series", "obs_date")


def quote_status(state):
    """Provider state to quote status: fresh, unavailable, anything else stale; none means fresh."""
    low = F.lower(F.coalesce(as_col(state), F.lit("fresh")))
    return F.when(low == "unavailable", F.lit("UNAVAILABLE")).when(low == "fresh", F.lit("FRESH")).otherwise(F.lit("STALE"))


def series_status(status, live):
    return F.when(as_col(status).isin(list(live)), F.lit("LIVE")).otherwise(F.lit("STALE"))


def last_wins(obs: DataFrame, tier, order, keys=KEY) -> DataFrame:
    """One row per key: highest tier, then the latest in order."""
    return first_per_key(obs, list(keys), [as_col(tier).desc(), *[F.desc(o) for o in order]])


def series_upsert(old: DataFrame, new: DataFrame, order=("event_id",), keys=KEY) -> DataFrame:
    """stored ∪ new by date; new wins, and the later row wins within one side."""
    both = old.withColumn("_tier", F.lit(0)).unionByName(new.withColumn("_tier", F.lit(1)))
    return last_wins(both, "_tier", order, keys).drop("_tier")


def series_fill_only(base: DataFrame, fill: DataFrame, order=("event_id",), keys=KEY) -> DataFrame:
    """base plus the first fill row of every date base lacks."""
    missing = fill.join(base.select(*keys).distinct(), list(keys), "left_anti")
    return base.unionByName(first_per_key(missing, list(keys), order))


def tiered_merge(legacy: DataFrame, stored: DataFrame, current: DataFrame, order=("event_id",), keys=KEY) -> DataFrame:
    """Legacy fills only, stored beats it, current overwrites both."""
    tagged = [df.withColumn("_tier", F.lit(i)) for i, df in enumerate((legacy, stored, current))]
    return last_wins(tagged[0].unionByName(tagged[1]).unionByName(tagged[2]), "_tier", order, keys).drop("_tier")


def granularity_priority(rows: DataFrame, order=("event_id",), keys=KEY) -> DataFrame:
    """Same end date: a monthly average beats a two-month one; the first row wins ties."""
    rank = F.when(F.col("observation_type") == "monthly_average", F.lit(2)).otherwise(F.lit(1))
    return first_per_key(rows, list(keys), [rank.desc(), *order])


def conflict_report(rows: DataFrame, eps: float, order: str = "event_id", keys=KEY) -> DataFrame:
    """Rows that disagree with the first value of their key by more than ``eps``."""
    first = rows.groupBy(*keys).agg(F.min_by("value", order).alias("kept_value"))
    differs = F.round(F.abs(F.col("value") - F.col("kept_value")), 9) > eps
    return rows.join(first, list(keys)).filter(differs).select(*keys, order, "kept_value", "value")


def typed_conflicts(rows: DataFrame, eps: float, order: str = "event_id", keys=KEY, kind: str = "observation_type") -> DataFrame:
    """Rows that disagree with the kept row of their own type by more than ``eps``.

    The first row of a key is kept until the first monthly average takes its place, so what is kept
    at any row follows from the first row and the first monthly one: two grouped minima.
    """
    monthly = F.col(kind) == "monthly_average"
    row = F.struct(order, "value")
    kept = rows.groupBy(*keys).agg(F.min(row).alias("_first"), F.min_by(kind, order).alias("_kind"), F.min(F.when(monthly, row)).alias("_month"))
    at = F.col(order)
    late = F.col("_month").isNotNull() & (at > F.col(f"_month.{order}"))
    against = F.when(late & monthly, F.col("_month.value")).when(~late & (at > F.col(f"_first.{order}")) & (F.col(kind) == F.col("_kind")), F.col("_first.value"))
    told = rows.join(kept, list(keys)).withColumn("kept_value", against)
    return told.filter(F.round(F.abs(F.col("value") - F.col("kept_value")), 9) > eps).select(*keys, order, "kept_value", "value")


RANGES = 64  # ranges a key with many rows is cut into
RANGE_ROWS = 50_000


def near(a: float, b: float, eps: float) -> bool:
    return round(abs(a - b), 9) <= eps


class Outcome:
    """What a run of values makes of any kept value: the first value within ``eps`` replaces it, and so on.

    ``after[i]`` is the kept value at the end if value i has just been taken; a value before the run is taken
    over by the first one near it, so the pieces ``starts`` to ``ends`` of the number line share one outcome.
    """

    def __init__(self, values: list[float], eps: float):
        self.eps, self.starts, self.ends, self.last = eps, [], [], []
        grid = sorted(set(values))
        size = len(grid)
        tree = [math.inf] * (2 * size)  # least index of a value, by its place among the sorted ones
        after = [0.0] * len(values)
        for i in range(len(values) - 1, -1, -1):
            lo, hi = self.around(grid, values[i])
            j = self.least(tree, size, lo, hi)
            after[i] = after[j] if j < math.inf else values[i]
            at = bisect_left(grid, values[i]) + size
            while at:
                tree[at] = min(i, tree[2 * at], tree[2 * at + 1]) if at < size else i
                at >>= 1
        self.first = after[0] if after else None
        for i, v in enumerate(values):
            self.cover(v - eps - 5e-10, v + eps + 5e-10, after[i])

    def around(self, grid, v) -> tuple[int, int]:
        lo, hi = bisect_left(grid, v - self.eps - 1e-9), bisect_right(grid, v + self.eps + 1e-9)
        while lo < hi and not near(grid[lo], v, self.eps):
            lo += 1
        while hi > lo and not near(grid[hi - 1], v, self.eps):
            hi -= 1
        return lo, hi

    @staticmethod
    def least(tree, size, lo, hi):
        best, lo, hi = math.inf, lo + size, hi + size
        while lo < hi:
            if lo & 1:
                best, lo = min(best, tree[lo]), lo + 1
            if hi & 1:
                hi -= 1
                best = min(best, tree[hi])
            lo, hi = lo >> 1, hi >> 1
        return best

    def cover(self, lo: float, hi: float, outcome: float) -> None:
        """Give the parts of [lo, hi] that no earlier value took their outcome."""
        at = bisect_left(self.ends, lo)
        new = []
        while lo < hi:
            if at < len(self.starts) and self.starts[at] < hi:
                if lo < self.starts[at]:
                    new.append((at, lo, self.starts[at]))
                lo, at = max(lo, self.ends[at]), at + 1
            else:
                new.append((at, lo, hi))
                break
        for place, s, e in reversed(new):
            self.starts.insert(place, s)
            self.ends.insert(place, e)
            self.last.insert(place, outcome)

    def of(self, kept: float) -> float:
        at = bisect_left(self.ends, kept)
        return self.last[at] if at < len(self.starts) and self.starts[at] <= kept else kept


def moving_conflicts(rows: DataFrame, eps: float, order: str = "event_id", keys=KEY) -> DataFrame:
    """Rows that disagree by more than ``eps`` with the kept value, which each agreeing row replaces.

    A running fold without a key in one task: a key with many rows is cut into ranges of its order, each range
    is summed up by its ``Outcome`` in a task of its own, the outcomes of a key are applied in turn to
    give every range the value it starts with, and the ranges are then replayed side by side.
    """
    keys = list(keys)
    rows = rows.select(*keys, order, "value").filter("value IS NOT NULL")
    cuts = F.percentile_approx(order, [k / RANGES for k in range(1, RANGES)], 10_000)
    sizes = rows.groupBy(*keys).agg(F.when(F.count(F.lit(1)) > RANGE_ROWS, cuts).otherwise(F.array().cast(f"array<{rows.schema[order].dataType.simpleString()}>")).alias("_cuts"))
    ranged = cut_lineage(rows.join(sizes, keys).withColumn("span", F.size(F.filter("_cuts", lambda c: c < F.col(order)))).drop("_cuts"))
    typed = {f.name: f.dataType.simpleString() for f in ranged.schema}
    spread = lambda df: df.repartition(*keys, "span").sortWithinPartitions(*keys, "span", order)
    named = ", ".join(f"{k} {typed[k]}" for k in [*keys, "span"])

    def runs(batches):
        """(key and range, rows) of a sorted stream, whole ranges at a time."""
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if len(held):
                tail = (held[[*keys, "span"]] == held[[*keys, "span"]].iloc[-1]).all(axis=1)
                done, held = held[~tail], held[tail]
                yield from done.groupby([*keys, "span"], sort=False, dropna=False)
        if held is not None and len(held):
            yield from held.groupby([*keys, "span"], sort=False, dropna=False)

    def summed(batches):
        for key, part in runs(batches):
            made = Outcome(part["value"].tolist(), eps)
            yield pd.DataFrame([(*key, made.first, made.starts, made.ends, made.last)], columns=[*keys, "span", "first", "starts", "ends", "last"])

    outcomes = spread(ranged).mapInPandas(summed, f"{named}, first double, starts array<double>, ends array<double>, last array<double>")

    def carried(frame: pd.DataFrame) -> pd.DataFrame:
        kept, out = None, []
        for r in frame.sort_values("span").itertuples(index=False):
            out.append(kept)
            made = object.__new__(Outcome)
            made.starts, made.ends, made.last = list(r.starts), list(r.ends), list(r.last)
            kept = r.first if kept is None else made.of(kept)
        return frame.sort_values("span")[[*keys, "span"]].assign(start_value=pd.Series(out, dtype="float64").to_numpy())

    starts = outcomes.groupBy(*keys).applyInPandas(carried, f"{named}, start_value double")

    def replayed(batches):
        at = kept = None  # the range of the row before and the value kept there; a batch is answered at once
        for batch in batches:
            held = []
            places = zip(*[batch[k].astype(object).where(batch[k].notna(), None) for k in [*keys, "span"]])
            for place, start, value in zip(places, batch["start_value"].tolist(), batch["value"].tolist()):
                if place != at:
                    at, kept = place, start
                differs = not (kept is None or kept != kept or near(kept, value, eps))
                kept = kept if differs else value
                held.append(kept if differs else None)
            told = batch[[*keys, order]].assign(kept_value=pd.Series(held, index=batch.index, dtype="float64"), value=batch["value"])
            yield told[told["kept_value"].notna()]

    schema = ", ".join(f"{k} {typed[k]}" for k in [*keys, order]) + ", kept_value double, value double"
    return spread(ranged.join(starts, [*keys, "span"])).mapInPandas(replayed, schema)


def previous_value(df: DataFrame, keys, date: str, value: str, order: str) -> DataFrame:
    """Previous value in (date, order) per key, without one task holding a whole key.

    Rows are dealt by ranges of (key, date, order), so a long series lies in many partitions; each gives its
    last value of a key to the next one that holds the key.
    """
    ranged = cut_lineage(df.repartitionByRange(*keys, date, order).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy(*keys, "_part").orderBy(date, order)
    ends = ranged.groupBy(*keys, "_part").agg(F.max_by(value, F.struct(date, order)).alias("_end"))
    carry = ends.select(*keys, "_part", F.lag("_end").over(Window.partitionBy(*keys).orderBy("_part")).alias("_carry"))
    marked = ranged.withColumns({"_n": F.row_number().over(inside), "_prev": F.lag(value).over(inside)})
    joined = marked.join(carry, [*keys, "_part"], "left")
    prev = F.when(F.col("_n") == 1, F.col("_carry")).otherwise(F.col("_prev"))
    return joined.withColumn("prev_value", prev).drop("_part", "_n", "_prev", "_carry")


def day_over_day_check(
    obs: DataFrame, lo: float = 100, hi: float = 20000, jump: float = 0.25, keys=("series",), order: str = "event_id"
) -> DataFrame:
    """Every observation with its plausibility flags."""
    df = previous_value(obs, keys, "obs_date", "value", order)
    return df.withColumns(
        {
            "implausible": ~((F.col("value") > lo) & (F.col("value") < hi)),
            "jumped": F.coalesce(F.abs(F.try_divide("value", "prev_value") - 1) > jump, F.lit(False)),
        }
    )


def batch_validity(obs: DataFrame, as_of: str, min_rows: int, keys, lo=100, hi=20000, jump=0.25, stale_days=10) -> DataFrame:
    """Per provider batch: whether size, freshness, bounds and daily jumps all hold."""
    checked = day_over_day_check(obs, lo, hi, jump, keys)
    return checked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max("obs_date").alias("last_date"),
        F.count_if("implausible").alias("n_implausible"),
        F.count_if("jumped").alias("n_jumps"),
    ).withColumn(
        "valid",
        (F.col("n_rows") >= min_rows)
        & (F.col("last_date") >= F.date_sub(as_of_lit(as_of).cast("date"), stale_days))
        & (F.col("n_implausible") == 0)
        & (F.col("n_jumps") == 0),
    )


def provider_fallback(obs: DataFrame, as_of: str, min_rows: int, **limits) -> DataFrame:
    """Rows of the first provider (by ``priority``) whose whole batch is valid, per series."""
    valid = batch_validity(obs, as_of, min_rows, ("series", "provider", "priority"), **limits).filter("valid")
    chosen = valid.groupBy("series").agg(F.min_by("provider", "priority").alias("provider"))
    return obs.join(chosen, ["series", "provider"], "left_semi")


def best_provider(obs: DataFrame) -> DataFrame:
    """Rows of the provider with most observations per series; the first listed wins ties."""
    sizes = obs.groupBy("series", "provider", "priority").agg(F.count(F.lit(1)).alias("n"))
    chosen = sizes.groupBy("series").agg(F.max_by("provider", F.struct("n", -F.col("priority"))).alias("provider"))
    return obs.join(chosen, ["series", "provider"], "left_semi")


def last_close(obs: DataFrame, order: str = "event_id") -> DataFrame:
    return obs.groupBy("series").agg(
        F.max_by("value", F.struct("obs_date", order)).alias("last_close"), F.max("obs_date").alias("last_date")
    )


def quote_divergence(quotes: DataFrame, obs: DataFrame, limit: float = 0.12, order: str = "event_id") -> DataFrame:
    """Quote against last close; ``rejected`` batches keep their stored history."""
    joined = quotes.join(last_close(obs, order), "series")
    off = F.abs(F.try_divide("price", "last_close") - 1)
    return joined.withColumn("divergence", off).withColumn("rejected", F.coalesce(off > limit, F.lit(False)))


def stale_quote_keep(old: DataFrame, new: DataFrame) -> DataFrame:
    """New quote where there is one, else the stored one marked stale."""
    o = old.select("series", F.col("price").alias("_old"), F.col("quote_ts").alias("_old_ts"))
    n = new.select("series", "price", "quote_ts")
    fresh = F.col("price").isNotNull()
    return o.join(n, "series", "full").select(
        "series",
        F.coalesce("price", "_old").alias("price"),
        F.when(fresh, F.col("quote_ts")).otherwise(F.col("_old_ts")).alias("quote_ts"),
        F.when(fresh, F.lit("FRESH")).otherwise(F.lit("STALE_STORED_QUOTE")).alias("quote_status"),
    )


def quote_change_pct(quotes: DataFrame, obs: DataFrame, order: str = "event_id") -> DataFrame:
    return quotes.join(last_close(obs, order), "series").withColumn("change_pct", pct_change("price", "last_close"))


def min_rows_guard(obs: DataFrame, required: int) -> DataFrame:
    n = obs.groupBy("series").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumns({"required": F.lit(required), "ok": F.col("n") >= required})


def convert_units(cells: DataFrame, key: str = "page_id") -> DataFrame:
    """Per-gallon readings to dollars per barrel (42 gallons), kept within 10–500.

    Unit: named in ``page_text``; else cents when the page's upper-median reading exceeds 10. The
    median is an exact discrete percentile, an aggregate that combines map-side.
    """
    median = cells.groupBy(key).agg(
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY value DESC)").alias("_median"), F.first("page_text").alias("_text")
    )
    cents = F.col("_text").contains("cents") & F.col("_text").contains("gallon")
    dollars = F.col("_text").contains("dollars per gallon")
    unit = F.when(cents, F.lit("cents")).when(dollars, F.lit("dollars")).when(
        F.col("_median") > 10, F.lit("cents")
    ).otherwise(F.lit("dollars"))
    named = median.select(key, unit.alias("unit"))
    scaled = F.when(F.col("unit") == "cents", F.col("value") * 42.0 / 100.0).otherwise(F.col("value") * 42.0)
    out = cells.drop("page_text").join(named, key).withColumn("value", F.bround(scaled, 2))
    return out.filter(F.col("value").between(10, 500))


def changed_rows(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Symmetric difference of two tables; empty when a rewrite would change nothing."""
    gone = stored.exceptAll(fresh).withColumn("change", F.lit("removed"))
    return gone.unionByName(fresh.exceptAll(stored).withColumn("change", F.lit("added")))
