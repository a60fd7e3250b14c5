"""The streams: same star as in batch, resume, replay, first row wins, dedup and counts."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clickstar import fixtures as fx
from clickstar.operators.geo import geo_table
from clickstar.plans import star
from clickstar.plans.enrich import enrich
from clickstar.runtime import scratch_path, shared_root
from clickstar.schema import FACT, WAREHOUSE
from clickstar.sources import warehouse as wh
from clickstar.sources.messages import (
    accepted_events,
    kafka_options,
    parse_messages,
    read_message_stream,
    read_messages,
    relay,
)
from clickstar.streaming import star as streaming_star
from clickstar.streaming.dedup import dedup_events
from clickstar.streaming.star import start_star_stream, write_star

NOW = {"availableNow": True}
VIEW = "view_product_detail"


@pytest.fixture(scope="module")
def geo(spark, sf_dir):
    return geo_table(fx.geo_ranges(spark, sf_dir))


def put(folder, name, *messages):
    folder.mkdir(exist_ok=True)
    lines = [m if isinstance(m, str) else json.dumps(m) for m in messages]
    (folder / name).write_text("\n".join(lines) + "\n")


def event(n, **more):
    return {"id": f"e{n}", "collection": VIEW, "time_stamp": 1716883882 + n, "store_id": "1", **more}


def run(spark, folder, warehouse, checkpoint, geo, **more):
    stream = read_message_stream(spark, "text", path=str(folder))
    start_star_stream(stream, warehouse, checkpoint, geo, trigger=NOW, **more).awaitTermination()


def paths(spark):
    return scratch_path(spark, "warehouse"), scratch_path(spark, "checkpoint")


def test_stream_equals_batch(spark, sf_dir, geo):
    files = scratch_path(spark, "messages")
    fx.raw_messages(spark, sf_dir).repartition(6).write.text(files)
    warehouse, checkpoint = paths(spark)
    stream = read_message_stream(spark, "text", {"maxFilesPerTrigger": "2"}, files)
    query = start_star_stream(stream, warehouse, checkpoint, geo, "brand-", NOW)
    query.awaitTermination()
    epochs = wh.read_table(spark, warehouse, FACT).select(wh.EPOCH).distinct().count()
    assert epochs == 3
    tables = wh.read_warehouse(spark, warehouse)
    batch = star.star_tables(enrich(accepted_events(fx.raw_events(spark, sf_dir)), geo), "brand-")
    for table, schema in WAREHOUSE.items():
        if table in ("dim_product", "dim_store"):  # named by the first batch, not the first event
            key = schema.fieldNames()[0]
            assert rows(tables[table], key) == rows(batch[table], key)
        else:
            assert rows(tables[table], *schema.fieldNames()) == rows(batch[table])


def test_dirty_messages_and_canaries_do_not_stop_the_stream(spark, tmp_path, geo):
    folder = tmp_path / "in"
    put(
        folder, "1.txt", event(1), '{"id": "broken', "", "null",
        {"message_id": "m", "type": "canary"}, {"id": "x", "collection": "checkout"},
        {"collection": VIEW}, event(2, time_stamp=10**30, option=[{"option_id": "1"}]),
    )
    warehouse, checkpoint = paths(spark)
    run(spark, folder, warehouse, checkpoint, geo)
    fact = wh.read_table(spark, warehouse, FACT)
    assert rows(fact, "event_id", "time_id") == {("e1", 2024052808), ("e2", None)}


@pytest.mark.parametrize("ids_keep_their_date", [False, True])
def test_resume_adds_only_new_ids_and_first_row_wins(spark, tmp_path, geo, ids_keep_their_date):
    folder = tmp_path / "in"
    warehouse, checkpoint = paths(spark)
    put(folder, "1.txt", event(1, store_id="07"), event(2))
    run(spark, folder, warehouse, checkpoint, geo, ids_keep_their_date=ids_keep_their_date)
    put(folder, "2.txt", event(1, store_id="9"), event(3, store_id="7"), event(4, time_stamp=None))
    run(spark, folder, warehouse, checkpoint, geo, ids_keep_their_date=ids_keep_their_date)
    put(folder, "3.txt", event(4, time_stamp=None))
    run(spark, folder, warehouse, checkpoint, geo, ids_keep_their_date=ids_keep_their_date)
    tables = wh.read_warehouse(spark, warehouse)
    assert rows(tables[FACT], "event_id", "store_id") == {("e1", 7), ("e2", 1), ("e3", 7), ("e4", 1)}
    assert rows(tables["dim_store"]) == {(7, "store_07"), (1, "store_1"), (9, "store_9")}


def test_an_id_of_another_date_is_still_the_same_id(spark, tmp_path, geo):
    folder = tmp_path / "in"
    warehouse, checkpoint = paths(spark)
    put(folder, "1.txt", event(1))
    run(spark, folder, warehouse, checkpoint, geo)
    put(folder, "2.txt", event(1, time_stamp=1800000000))
    run(spark, folder, warehouse, checkpoint, geo)
    assert rows(wh.read_table(spark, warehouse, FACT), "event_id", "time_id") == {("e1", 2024052808)}


def test_an_epoch_run_again_changes_nothing(spark, sf_dir, geo):
    warehouse, _ = paths(spark)
    batch = accepted_events(fx.raw_events(spark, sf_dir))
    write_star(batch, 0, warehouse, geo)
    write_star(batch, 1, warehouse, geo)
    before = {t: rows(wh.read_table(spark, warehouse, t)) for t in WAREHOUSE}
    write_star(batch, 1, warehouse, geo)
    write_star(batch, 0, warehouse, geo)
    assert {t: rows(wh.read_table(spark, warehouse, t)) for t in WAREHOUSE} == before


def test_a_table_that_fails_fails_the_batch(spark, sf_dir, geo, monkeypatch):
    warehouse, _ = paths(spark)

    def broken(*_args, **_more):
        raise OSError("disk")

    monkeypatch.setattr("clickstar.streaming.star.insert_if_absent", broken)
    with pytest.raises(OSError):
        write_star(accepted_events(fx.raw_events(spark, sf_dir)), 0, warehouse, geo)


def test_new_checkpoint_over_streamed_epochs_is_refused(spark, tmp_path, geo):
    folder = tmp_path / "in"
    warehouse, checkpoint = paths(spark)
    put(folder, "1.txt", event(1))
    run(spark, folder, warehouse, checkpoint, geo)
    with pytest.raises(ValueError, match="another checkpoint"):
        run(spark, folder, warehouse, scratch_path(spark, "checkpoint"), geo)


def test_stream_goes_on_after_a_backfill(spark, tmp_path, geo):
    folder = tmp_path / "in"
    warehouse, checkpoint = paths(spark)
    put(folder, "1.txt", event(1), event(2))
    past = parse_messages(read_messages(spark, "text", path=str(folder)))
    star.build_warehouse(spark, accepted_events(past), geo, warehouse, scratch_path(spark, "stage"))
    put(folder, "2.txt", event(3))
    run(spark, folder, warehouse, checkpoint, geo)
    fact = wh.read_table(spark, warehouse, FACT)
    assert rows(fact, "event_id", wh.EPOCH) == {("e1", -1), ("e2", -1), ("e3", 0)}


def test_merged_epochs_hold_the_same_rows_and_the_stream_goes_on(spark, tmp_path, geo):
    folder = tmp_path / "in"
    warehouse, checkpoint = paths(spark)
    for n in range(3):
        put(folder, f"{n}.txt", event(n), event(n + 1, store_id=str(n)))
        run(spark, folder, warehouse, checkpoint, geo)
    merged = scratch_path(spark, "merged")
    wh.merge_epochs(spark, warehouse, merged)
    before, after = wh.read_warehouse(spark, warehouse), wh.read_warehouse(spark, merged)
    assert {t: rows(before[t]) for t in WAREHOUSE} == {t: rows(after[t]) for t in WAREHOUSE}
    put(folder, "9.txt", event(1), event(9))
    run(spark, folder, merged, checkpoint, geo)
    fact = wh.read_table(spark, merged, FACT)
    assert rows(fact, "event_id", wh.EPOCH) == {
        ("e0", -1), ("e1", -1), ("e2", -1), ("e3", -1), ("e9", 3),
    }


def test_dedup_within_delay(spark, tmp_path, geo):
    folder = tmp_path / "in"
    put(folder, "1.txt", event(1), event(1), event(2), event(3, time_stamp=None))
    stream = parse_messages(read_message_stream(spark, "text", path=str(folder)))
    query = (
        dedup_events(stream, "1 hour").writeStream.format("memory").queryName("deduped")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows(spark.table("deduped"), "id") == {("e1",), ("e2",), ("e3",)}
    warehouse, checkpoint = paths(spark)
    run(spark, folder, warehouse, checkpoint, geo, dedup_delay="1 hour")
    put(folder, "2.txt", event(4, time_stamp=1716990000), event(3, time_stamp=None))
    run(spark, folder, warehouse, checkpoint, geo, dedup_delay="1 hour")
    fact = wh.read_table(spark, warehouse, FACT)
    assert rows(fact, "event_id") == {("e1",), ("e2",), ("e3",), ("e4",)}


def test_relay_keeps_every_field(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    given = [{"id": "1", "new": {"a": [1, None, "x"]}, "time_stamp": 5}, {"type": "canary"}, {"big": 2**60}]
    put(folder, "1.txt", *given, "not json")
    stream = read_message_stream(spark, "text", path=str(folder))
    relay(stream, "text", scratch_path(spark, "checkpoint"), path=out).trigger(**NOW).start().awaitTermination()
    got = [json.loads(row[0]) for row in spark.read.text(out).collect()]
    assert sorted(map(str, got)) == sorted(map(str, given))


def test_kafka_options_name_what_is_given():
    options = kafka_options("broker:9092", "views", security_protocol="SASL_PLAINTEXT", minPartitions="64")
    assert options == {
        "kafka.bootstrap.servers": "broker:9092",
        "kafka.security.protocol": "SASL_PLAINTEXT",
        "subscribe": "views",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "minPartitions": "64",
    }


def test_scratch_lies_in_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == named
    assert scratch_path(spark, "a").startswith(named + "/a-")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_a_batch_is_staged_in_files_and_not_kept_in_executors(spark, tmp_path, geo, monkeypatch):
    def refuse(*_):
        raise AssertionError("a batch kept in executors")

    warehouse, _ = paths(spark)
    batch = spark.createDataFrame([("e1", VIEW, 1716883882), ("e2", VIEW, 1716883882)], "id string, collection string, time_stamp long")
    monkeypatch.setattr(type(batch), "persist", refuse)
    staged = []
    keep = streaming_star.stored
    monkeypatch.setattr(streaming_star, "stored", lambda df, path: staged.append(path) or keep(df, path))
    write_star(batch.where("id = 'e1'"), 0, warehouse, geo)
    write_star(batch, 1, warehouse, geo)
    assert rows(wh.read_table(spark, warehouse, FACT), "event_id", wh.EPOCH) == {("e1", 0), ("e2", 1)}
    assert len(staged) == 4 and not any(wh.path_exists(spark, path) for path in staged)


def test_more_events_are_more_files_and_no_more_epochs(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(fx, "_FILE_EVENTS", 100)
    files = []
    path = entry.scratch_path
    monkeypatch.setattr(entry, "scratch_path", lambda s, name: files.append((name, path(s, name))) or files[-1][1])
    warehouse = entry._many_epochs(spark, sf_dir)
    an_epoch = fx.message_files(spark, sf_dir)
    written = spark.read.text(dict(files)["messages"])
    sizes = [n for _, n in written.groupBy(F.input_file_name()).count().collect()]
    assert an_epoch == 3 and len(sizes) == 5 * an_epoch
    # No file, and so no task, holds a delivery.
    assert 4 * max(sizes) < sum(sizes)
    assert wh.read_table(spark, warehouse, FACT).agg(F.max(wh.EPOCH)).first()[0] <= 3
    plan = fx.dealt_messages(spark, sf_dir, 3)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan
