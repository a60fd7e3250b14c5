"""Epoch folders and their merges, the key index, hourly counts, first rows without sorts."""

import random
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickstar import fixtures as fx
from clickstar.operators.geo import geo_table
from clickstar.operators.rows import deliveries, earliest_per_key, first_deliveries
from clickstar.plans import star
from clickstar.plans.enrich import enrich
from clickstar.runtime import scratch_path
from clickstar.schema import FACT, WAREHOUSE
from clickstar.sources import keyindex, rollups, runs
from clickstar.sources import warehouse as wh
from clickstar.sources.messages import accepted_events
from clickstar.streaming.star import merge_star, write_star

NAMES = WAREHOUSE[FACT].fieldNames()


def fact_rows(spark, ids, product=1, hour=2024010100):
    data = [(f"e{n}", "view", hour, product, None, None, None, None, None) for n in ids]
    return spark.createDataFrame(data, WAREHOUSE[FACT]).coalesce(1)


def folders(spark, warehouse, table):
    path = f"{warehouse}/{table}"
    return len(runs.folder_names(spark, path)) + len(runs.folder_names(spark, f"{path}.merged"))


def size(paths):
    return sum(f.stat().st_size for path in paths for f in Path(path).rglob("*.parquet"))


def test_many_epochs_leave_few_folders_and_batches_read_little(spark):
    epochs = 40
    warehouse = scratch_path(spark, "warehouse")
    index = wh.fact_index(warehouse)
    read, most = [], 0
    for epoch in range(epochs):
        merge_star(spark, warehouse, epoch, index, 4)
        # Nine new ids; every tenth epoch brings one from long ago again, with another product.
        ids = [epoch * 9 + k for k in range(9)] + ([epoch] if epoch % 10 == 9 else [])
        batch = fact_rows(spark, ids, product=epoch)
        wh.insert_if_absent(batch, warehouse, FACT, epoch, index=index)
        read.append(size(index.asked))
        most = max(most, folders(spark, warehouse, FACT))
        assert len(runs.folder_names(spark, f"{warehouse}/{FACT}.filters")) <= 30
    fact = wh.read_table(spark, warehouse, FACT)
    got = {(r["event_id"], r["product_id"]) for r in fact.collect()}
    assert got == {(f"e{n}", n // 9) for n in range(9 * epochs)} and fact.count() == 9 * epochs
    # Ids are read of one folder, and only where one came again: no more as history grows.
    assert most <= 20
    assert [n > 0 for n in read] == [epoch % 10 == 9 for epoch in range(epochs)]
    assert max(read) <= 3 * min(n for n in read if n)
    # Rows keep their epoch through all merges.
    assert {r[0]: r[1] for r in fact.groupBy(runs.EPOCH).count().collect()} == {e: 9 for e in range(epochs)}


def test_an_epoch_run_again_after_a_merge_changes_nothing(spark):
    warehouse = scratch_path(spark, "warehouse")
    index = wh.fact_index(warehouse)

    def run(epoch):
        merge_star(spark, warehouse, epoch, index, 2)
        batch = fact_rows(spark, [epoch, epoch + 1], product=epoch)
        wh.insert_if_absent(
            batch, warehouse, FACT, epoch, index=index,
            also=lambda new: rollups.write_rollup_epoch(
                new.withColumn("domain_country", F.lit("fr")), warehouse, epoch
            ),
        )

    def state():
        counts = rollups.read_rollup(spark, warehouse, "product").groupBy("product_id").agg(F.sum("views"))
        return rows(wh.read_table(spark, warehouse, FACT)), rows(counts)

    for epoch in range(6):
        run(epoch)
    before = state()
    assert len(before[0]) == 7 and before[1] == {(0, 2), *((e, 1) for e in range(1, 6))}
    # The last epoch, the one before it, and one that a merge has taken in long ago.
    for epoch in (5, 4, 5, 1):
        run(epoch)
        assert state() == before
    # With an object of its own, as after a restart.
    index = wh.fact_index(warehouse)
    run(6)
    assert len(state()[0]) == 8


def test_a_broken_merge_is_passed_over_and_done_again(spark):
    warehouse = scratch_path(spark, "warehouse")
    for epoch in range(4):
        wh.write_epoch(fact_rows(spark, [epoch]), warehouse, FACT, epoch)
    before = rows(wh.read_table(spark, warehouse, FACT))
    half = Path(f"{warehouse}/{FACT}.merged/run=1-0-3/event_date=2024-01-01")
    half.mkdir(parents=True)
    assert rows(wh.read_table(spark, warehouse, FACT)) == before
    assert wh.merge_table(spark, warehouse, FACT, 4, 4) == []
    assert runs.runs(spark, f"{warehouse}/{FACT}") == [runs.Run(0, 3, 1)]
    assert rows(wh.read_table(spark, warehouse, FACT)) == before
    # What is covered goes with the next merge; an epoch of a backfill is never merged.
    for epoch in [-1, *range(4, 8)]:
        wh.write_epoch(fact_rows(spark, [epoch]), warehouse, FACT, epoch)
    removed = wh.merge_table(spark, warehouse, FACT, 8, 4)
    assert [run.first for run in removed] == [0, 1, 2, 3]
    assert [run.name for run in runs.runs(spark, f"{warehouse}/{FACT}")] == ["0--1--1", "1-0-3", "1-4-7"]
    assert wh.read_table(spark, warehouse, FACT).count() == 9


@pytest.mark.parametrize("key_bits, prefix_keys", [(8, 100_000), (1, 50)])
def test_absent_keys_are_exact(spark, monkeypatch, key_bits, prefix_keys):
    """Also with filters so coarse that they suspect unknown keys, and many prefixes."""
    monkeypatch.setattr(keyindex, "KEY_BITS", key_bits)
    monkeypatch.setattr(keyindex, "PREFIX_KEYS", prefix_keys)
    rng = random.Random(key_bits)
    warehouse = scratch_path(spark, "warehouse")
    index = wh.fact_index(warehouse)
    known = set()
    for epoch in (-1, 0, 1, 2):
        ids = set(rng.sample(range(5_000), 700 if epoch < 0 else 60)) - known
        wh.write_epoch(fact_rows(spark, ids), warehouse, FACT, epoch)
        known |= ids
    asked = rng.sample(range(5_000), 900)
    fresh = index.absent(fact_rows(spark, asked), 3)
    assert rows(fresh, "event_id") == {(f"e{n}",) for n in set(asked) - known}
    unknown = index.absent(fact_rows(spark, range(10_000, 10_400)), 3)
    assert unknown.count() == 400
    assert bool(index.asked) == (key_bits == 1)
    # Of later epochs nothing is known.
    assert index.absent(fact_rows(spark, asked), -1).count() == len(asked)


def test_a_broken_index_is_built_again(spark):
    warehouse = scratch_path(spark, "warehouse")
    index = wh.fact_index(warehouse)
    wh.write_epoch(fact_rows(spark, range(50)), warehouse, FACT, 0)
    asked = fact_rows(spark, range(40, 60))
    assert index.absent(asked, 1).count() == 10
    # As a stream leaves it that was broken off before the filter was whole.
    filters = Path(f"{warehouse}/{FACT}.filters")
    (folder,) = filters.iterdir()
    for left in folder.iterdir():
        left.unlink()
    assert rows(index.absent(asked, 1), "event_id") == {(f"e{n}",) for n in range(50, 60)}
    assert (folder / "_SUCCESS").exists()
    # Of folders that a merge has taken over, the indexes go with them.
    for epoch in (1, 2, 3):
        wh.write_epoch(fact_rows(spark, [100 + epoch]), warehouse, FACT, epoch)
        index.absent(asked, epoch + 1)
    index.forget(spark, wh.merge_table(spark, warehouse, FACT, 4, 4))
    assert index.absent(asked, 4).count() == 10
    for epoch in (4, 5, 6, 7):
        wh.write_epoch(fact_rows(spark, [100 + epoch]), warehouse, FACT, epoch)
    index.forget(spark, wh.merge_table(spark, warehouse, FACT, 8, 4))
    assert [path.name.split("_")[0] for path in filters.iterdir()] == ["run=1-0-3"]


def test_merged_rollups_are_one_row_for_an_hour_and_its_keys(spark):
    warehouse = scratch_path(spark, "warehouse")
    for epoch in range(4):
        views = fact_rows(spark, [epoch]).withColumn("domain_country", F.lit("fr"))
        rollups.write_rollup_epoch(views, warehouse, epoch)
    counts = rollups.read_rollup(spark, warehouse, "domain_store")
    assert counts.count() == 4
    rollups.merge_rollups(spark, warehouse, 4, 4)
    merged = rollups.read_rollup(spark, warehouse, "domain_store").collect()
    assert [(str(r["event_date"]), r["domain_country"], r["store_id"], r["views"]) for r in merged] == [
        ("2024-01-01", "fr", None, 4)
    ]


def test_rollups_count_late_events_and_every_key(spark, sf_dir):
    warehouse = scratch_path(spark, "warehouse")
    geo = geo_table(fx.geo_ranges(spark, sf_dir))
    events = accepted_events(fx.raw_events(spark, sf_dir))
    # The second half of the month first, then the first half with some of what has been.
    late = F.col("time_stamp") < 1705276800
    write_star(events.where(~late), 0, warehouse, geo, fx.BRAND_PREFIX)
    write_star(events.where(late | (F.col("time_stamp") % 5 == 0)), 1, warehouse, geo, fx.BRAND_PREFIX)
    write_star(events.where(late | (F.col("time_stamp") % 5 == 0)), 1, warehouse, geo, fx.BRAND_PREFIX)
    views = star.unique_views(enrich(events, geo), star.COUNTED_COLUMNS)
    for name, keys in rollups.ROLLUPS.items():
        want = views.groupBy("time_id", *keys).agg(F.count("*").alias("views"))
        got = rollups.read_rollup(spark, warehouse, name)
        got = got.groupBy("time_id", *keys).agg(F.sum("views").alias("views"))
        assert rows(got) == rows(want)


def plain_first(data, width):
    best = {}
    for key, *row in data:
        if key is not None:
            rank = [(v is None, v) if v is not None else (True, 0) for v in row]
            if key not in best or rank < best[key][0]:
                best[key] = (rank, tuple(row))
    return {(key, *row[:width]) for key, (_, row) in best.items()}


def deliveries_like(n, keys):
    rng = random.Random(n)
    data = [(rng.choice(keys), rng.randint(0, 9), rng.choice("abc")) for _ in range(n)]
    return data + [(None, 1, "a"), (keys[0], None, "a"), ("only null", None, "b"), ("once", 3, "z")]


def test_first_rows_equal_plain_ones(spark):
    few = deliveries_like(400, ["k0", "k1", "k2"])
    many = deliveries_like(90, [f"k{n}" for n in range(80)])
    for data in (few, many, many + many):
        df = spark.createDataFrame(data, "key string, at long, payload string").repartition(3)
        assert rows(earliest_per_key(df, "key", ["at"], ["payload"])) == plain_first(data, 2)
        stored = deliveries(df, "key", "at", ["payload"]).persist()
        assert rows(first_deliveries(stored, "key", "at", ["payload"])) == plain_first(data, 2)
        stored.unpersist()


def test_no_sort_below_the_shuffle_of_deliveries(spark, sf_dir):
    enriched = enrich(accepted_events(fx.raw_events(spark, sf_dir)), geo_table(fx.geo_ranges(spark, sf_dir)))
    plans = [
        star.delivered_views(enriched, star.COUNTED_COLUMNS),
        star.dim_product(enriched),
    ]
    for df in plans:
        text = df._jdf.queryExecution().executedPlan().toString()
        # The first aggregate on the way up from the scans, which are at the bottom.
        below = text[text.rindex("Exchange hashpartitioning") :]
        assert "SortAggregate" not in below.split("Scan")[0], text
    assert "Sort" not in plans[0]._jdf.queryExecution().executedPlan().toString()
