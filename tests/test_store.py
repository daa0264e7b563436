"""The partition store, the pool and the archive as state, and conflicts of a moving value."""

import datetime as dt
import random

from pyspark.sql import functions as F

from newsgrid import views
from newsgrid.operators import dedupe, series
from newsgrid.sources import sinks
from newsgrid.sources.store import TableStore
from newsgrid.streaming import jobs

ROWS = "id int, day int, words array<string>, at timestamp_ntz"


def rows(spark, *told):
    return spark.createDataFrame([(i, d, w, dt.datetime(2024, 1, 1 + d)) for i, d, w in told], ROWS)


def test_only_changed_partitions_are_written(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), {"t": ROWS, "u": ROWS})
    assert store.read("t").count() == 0
    a = rows(spark, (1, 0, ["x", None]), (2, 1, []), (3, 2, None), (4, 2, ["y"]))
    assert store.commit({"t": (a, F.col("day")), "u": (a, F.lit(0))}) == {"t": 3, "u": 1}
    b = rows(spark, (4, 2, ["y"]), (3, 2, None), (1, 0, [None, "x"]), (2, 1, []))  # one day changed, order means nothing
    assert store.commit({"t": (b, F.col("day"))}) == {"t": 1}
    assert sorted(map(str, store.read("t").collect())) == sorted(map(str, b.collect()))
    assert store.read("u").count() == 4 and store.read("t", before=1).filter("id = 1").first()["words"] == ["x", None]
    gone = rows(spark, (2, 1, []))
    assert store.commit({"t": (gone, F.col("day"))}) == {"t": 0}
    assert [r["id"] for r in store.read("t").collect()] == [2]


def test_a_replayed_commit_changes_nothing_and_a_broken_one_is_not_seen(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"), {"t": ROWS})
    store.commit({"t": (rows(spark, (1, 0, [])), F.col("day"))}, 0)
    rows(spark, (9, 0, [])).drop("day").write.parquet(str(tmp_path / "s/t/commit=1/part=0"))  # a commit that never got its manifest
    assert [r["id"] for r in store.read("t").collect()] == [1]
    second = {"t": (rows(spark, (1, 0, []), (2, 5, [])), F.col("day"))}
    assert store.commit(second, 1) == store.commit(second, 1) == {"t": 1}
    assert sorted(r["id"] for r in store.read("t").collect()) == [1, 2]
    touched = {"t": (rows(spark, (7, 5, [])), F.col("day"))}
    store.commit(touched, 2, {"t": [5]})
    assert sorted(r["id"] for r in store.read("t").collect()) == [1, 7]


def test_pool_over_batches_equals_the_whole(spark, sf_dir, tmp_path):
    items = views.news_items(spark, sf_dir).select("doc_id", "id", "title", "summary", "source", "source_channel", "url", "published_at", "published_date", "author", "region_raw", "categories_raw")
    store = jobs.pool_store(spark, str(tmp_path / "p"), items.schema)
    parts = [items.filter("doc_id % 2 = 1"), items.filter("doc_id % 2 = 0")]
    for number, part in enumerate(parts):
        jobs.pool_step(store, part, number, ("doc_id",))
    jobs.pool_step(store, parts[1], 1, ("doc_id",))  # replayed
    got = sorted(r["doc_id"] for r in store.read("pool").collect())
    assert got == sorted(r["doc_id"] for r in dedupe.dedupe_best(items).collect())


def test_archive_state_is_read_and_a_replay_does_nothing(spark, tmp_path, monkeypatch):
    """Each batch starts from the commits before it; the fold itself is tested in test_streaming."""

    def step(stories, members, items, as_of, days, keep_days):
        new = items.join(members, items["id"] == members["raw_id"], "left_anti")
        fresh = new.selectExpr("id", "title", "'c' category", "'r' region", "'m' analysis_mode", "published_at", "1 importance_score", "array('e') entities", "array(named_struct('name', 'n', 'url', id)) sources")
        kept = stories.unionByName(fresh).filter("published_at >= '2024-01-02'")
        return kept, members.unionByName(new.selectExpr("id", "id raw_id")).join(kept.select("id"), "id", "left_semi")

    monkeypatch.setattr(jobs, "archive_step", step)
    store = jobs.archive_store(spark, str(tmp_path / "a"))
    item = lambda *told: spark.createDataFrame([(i, t, dt.datetime(2024, 1, d)) for i, t, d in told], "id string, title string, published_at timestamp_ntz")
    jobs.archive_batch(store, item(("a", "one", 3), ("b", "two", 4), ("x", "expired", 1)), 0, "2024-01-09")
    second = item(("b", "again", 4), ("c", "late", 3))
    written = jobs.archive_batch(store, second, 1, "2024-01-09")
    first = sorted(map(str, store.read("stories").collect()))
    assert jobs.archive_batch(store, second, 1, "2024-01-09") == written and sorted(map(str, store.read("stories").collect())) == first
    assert sorted((r["id"], r["title"]) for r in store.read("stories").collect()) == [("a", "one"), ("b", "two"), ("c", "late")]
    assert written["stories"] == 1 and sorted(r["raw_id"] for r in store.read("members").collect()) == ["a", "b", "c"]


def plain_moving(values, eps):
    kept, out = None, []
    for n, v in enumerate(values):
        if kept is None or round(abs(kept - v), 9) <= eps:
            kept = v
        else:
            out.append((n, kept, v))
    return out


def test_moving_conflicts_in_ranges(spark, monkeypatch):
    """One key with all rows, cut into ranges, gives what a single fold gives."""
    monkeypatch.setattr(series, "RANGE_ROWS", 50)
    rng = random.Random(3)
    values = [round(rng.choice([10, 10.5, 11, 30]) + rng.random(), 2) for _ in range(3000)]
    told = [("s", dt.date(2024, 1, 1), n, v) for n, v in enumerate(values)] + [("t", dt.date(2024, 1, 1), 1, 5.0), ("t", dt.date(2024, 1, 1), 2, 9.0)]
    df = spark.createDataFrame(told, "series string, obs_date date, event_id long, value double").repartition(7)
    got = sorted((r["event_id"], r["kept_value"], r["value"]) for r in series.moving_conflicts(df, 0.4).filter("series = 's'").collect())
    assert got == plain_moving(values, 0.4)


def test_outcome_of_any_start():
    rng = random.Random(1)
    for _ in range(200):
        values = [round(rng.uniform(0, 5), 2) for _ in range(rng.randint(1, 40))]
        made = series.Outcome(values, 0.3)
        for start in [round(rng.uniform(-1, 6), 2) for _ in range(20)]:
            kept = start
            for v in values:
                kept = v if series.near(kept, v, 0.3) else kept
            assert made.of(start) == kept


def test_previous_value_of_one_long_series(spark):
    df = spark.range(5000).selectExpr("'s' series", "date_add(date'2024-01-01', cast(id div 50 as int)) obs_date", "id event_id", "cast(id as double) value").repartition(5)
    got = {r["event_id"]: r["prev_value"] for r in series.previous_value(df, ["series"], "obs_date", "value", "event_id").collect()}
    assert got == {k: None if k == 0 else float(k - 1) for k in range(5000)}


def test_write_if_changed_reads_no_stored_rows(spark, tmp_path):
    out = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert [sinks.write_if_changed(x, out) for x in (df, df.orderBy(F.desc("k")), df.limit(1), df.limit(1))] == [True, False, True, False]
    assert sinks.read_written(spark, out, df.schema).count() == 1
