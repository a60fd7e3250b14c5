"""The star in batch: rules, invariants, and the stored warehouse."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickstar import fixtures as fx
from clickstar.operators.geo import geo_table
from clickstar.operators.rows import with_columns_of
from clickstar.plans import audit, kpi, star
from clickstar.plans.enrich import enrich
from clickstar.runtime import scratch_path
from clickstar.schema import (
    ALLOWED_COLLECTIONS,
    CANARY_MESSAGE,
    DIMENSIONS,
    EVENT,
    FACT,
    WAREHOUSE,
    key_of,
)
from clickstar.sources import warehouse as wh
from clickstar.sources.messages import (
    accepted_events,
    canary_messages,
    intake_counts,
    parse_messages,
)

SHOWN = "product_detail_recommendation_visible"


def events(spark, *given):
    """Parsed events from dicts, with one place for all."""
    names = EVENT.fieldNames()
    data = [tuple(event.get(name) for name in names) for event in given]
    return spark.createDataFrame(data, EVENT)


@pytest.fixture(scope="module")
def geo(spark, sf_dir):
    return geo_table(fx.geo_ranges(spark, sf_dir))


@pytest.fixture(scope="module")
def stored(spark, sf_dir, geo):
    path = scratch_path(spark, "warehouse")
    accepted = accepted_events(fx.raw_events(spark, sf_dir))
    star.build_warehouse(spark, accepted, geo, path, scratch_path(spark, "stage"), "brand-")
    return path


def test_keys_of_tables():
    assert key_of(FACT) == "event_id"
    assert key_of("dim_referrer_url") == "referrer_url_id"
    assert len(DIMENSIONS) == 7 and len(ALLOWED_COLLECTIONS) == 6


def test_parsing_dirty_messages(spark):
    texts = [
        '{"id":"1","collection":"view_product_detail","store_id":96672,"time_stamp":1716883882,"new":1}',
        '{"id":"2","collection":"view_product_detail","time_stamp":"x","option":""}',
        '{"id":"3","collection":"view_product_detail","time_stamp":99999999999999999999}',
        '{"id":"4","collection":"view_product_detail","option":[{"option_id":"9","option_label":"l"}]}',
        '{"id":"5","collection":"checkout"}',
        '{"collection":"view_product_detail"}',
        '{"message_id":"m","message":"hello","timestamp":"now","type":"canary"}',
        '{"id":"7", "coll',
        "null",
        "",
    ]
    messages = spark.createDataFrame([(t.encode(),) for t in texts], "value binary")
    parsed = parse_messages(messages)
    assert parsed.schema == EVENT
    got = {r["id"]: r for r in accepted_events(parsed).collect()}
    assert set(got) == {"1", "2", "3", "4"}
    assert got["1"]["store_id"] == "96672" and got["1"]["time_stamp"] == 1716883882
    assert got["2"]["time_stamp"] is None and got["2"]["option"] is None
    assert got["3"]["time_stamp"] is None
    assert got["4"]["option"][0]["option_label"] == "l"
    assert rows(intake_counts(messages)) == {
        ("accepted", 4),
        ("not_allowed", 1),
        ("no_id", 1),
        ("no_collection", 2),
        ("malformed", 2),
    }
    assert canary_messages(messages).first()["message_id"] == "m"
    assert canary_messages(messages).schema == CANARY_MESSAGE


def test_products_of_recommendations_are_kept(spark):
    """A product seen only in recommendations is in the dimension, under the id on view."""
    given = events(
        spark,
        dict(id="1", collection=SHOWN, product_id="1", viewing_product_id="2", time_stamp=5, current_url="/b-ring"),
        dict(id="2", collection="view_product_detail", product_id="3", time_stamp=6, current_url="/late.html"),
        dict(id="3", collection="view_product_detail", product_id="3", time_stamp=1, current_url="/early.html"),
        dict(id="4", collection="view_product_detail", product_id="n/a", time_stamp=1, current_url="/x"),
    )
    assert rows(star.dim_product(enrich(given))) == {(2, "B Ring"), (3, "Early")}


def test_store_written_two_ways_is_one(spark):
    given = events(
        spark,
        dict(id="1", collection=SHOWN, store_id="085", time_stamp=9),
        dict(id="2", collection=SHOWN, store_id="85", time_stamp=3),
        dict(id="3", collection=SHOWN, store_id=None, time_stamp=1),
    )
    assert rows(star.dim_store(enrich(given))) == {(85, "store_85")}


def test_fact_has_one_row_per_event_and_null_keys_stay(spark, geo):
    given = events(
        spark,
        dict(id="1", collection=SHOWN, product_id="5", time_stamp=7200, ip="0.0.0.0"),
        dict(id="1", collection=SHOWN, product_id="5", time_stamp=7200, ip="0.0.0.0"),
        dict(id="1", collection=SHOWN, product_id="6", time_stamp=9000, ip="0.0.0.0"),
        dict(id="2", collection=SHOWN, product_id="5"),
    )
    fact = star.fact_view_event(enrich(given, geo))
    unknown = star.dim_location(enrich(given, geo)).first()["location_id"]
    got = rows(fact, "event_id", "event_type", "time_id", "product_id", "store_id", "location_id")
    assert got == {
        ("1", SHOWN, 1970010102, 5, None, unknown),
        ("2", SHOWN, None, 5, None, unknown),
    }
    assert fact.columns == WAREHOUSE[FACT].fieldNames()


def test_one_event_per_product(spark, geo):
    given = events(
        spark,
        dict(id="a", collection=SHOWN, product_id="5", time_stamp=8),
        dict(id="b", collection=SHOWN, product_id="5", time_stamp=4),
        dict(id="c", collection=SHOWN, product_id="6", time_stamp=4),
    )
    first = star.earliest_event_per_product(enrich(given, geo))
    assert rows(first, "event_id", "product_id") == {("b", 5), ("c", 6)}


def test_stored_warehouse_is_whole(spark, sf_dir, stored):
    checks = {(r["table_name"], r["check_name"]): r["n"] for r in audit.audit_warehouse(spark, stored).collect()}
    ids = accepted_events(fx.raw_events(spark, sf_dir)).select("id").distinct().count()
    assert checks[(FACT, "rows")] == ids
    assert all(n == 0 for (_, check), n in checks.items() if check != "rows")
    assert all(checks[(dim, "rows")] > 0 for dim in DIMENSIONS)


def test_audit_finds_faults(spark, stored):
    tables = dict(wh.read_warehouse(spark, stored))
    fact = tables[FACT]
    tables["dim_os"] = tables["dim_os"].where("os <> 'Windows'")
    tables["dim_store"] = tables["dim_store"].union(tables["dim_store"])
    lost = fact.agg(F.min("event_id")).first()[0]
    tables[FACT] = fact.withColumn("event_id", F.when(fact.event_id != lost, fact.event_id))
    checks = {(r["table_name"], r["check_name"]): r["n"] for r in audit.audit_star(tables).collect()}
    assert checks[(FACT, "orphan_os_id")] > 0
    assert checks[(FACT, "null_keys")] == 1
    assert checks[("dim_store", "duplicate_keys")] * 2 == checks[("dim_store", "rows")]


def test_missing_tables_are_named(spark):
    path = scratch_path(spark, "empty")
    assert audit.missing_tables(spark, path) == list(WAREHOUSE)
    with pytest.raises(ValueError, match="dim_time"):
        audit.audit_warehouse(spark, path)


def test_wrong_schema_is_refused(spark):
    with pytest.raises(ValueError, match="store_id"):
        wh.conform(spark.createDataFrame([("1", "s")], "store_id string, store_name string"), "dim_store")
    with pytest.raises(ValueError, match="store_name"):
        wh.conform(spark.createDataFrame([(1,)], "store_id int"), "dim_store")


def test_day_report_reads_one_day(spark, stored):
    fact = wh.read_warehouse(spark, stored)[FACT]
    plan = kpi.top_products(fact, fx.AS_OF)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "event_date#" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "ReadSchema: struct<product_id:int>" in scan


def test_reports_from_store_equal_reports_from_events(spark, sf_dir, stored, geo):
    tables = wh.read_warehouse(spark, stored)
    enriched = enrich(accepted_events(fx.raw_events(spark, sf_dir)), geo)
    views = star.unique_views(enriched, ["event_date", "product_id", "location_id"])
    assert rows(kpi.top_products(tables[FACT], fx.AS_OF)) == rows(kpi.top_products(views, fx.AS_OF))
    assert rows(kpi.top_ip_countries(tables[FACT], tables["dim_location"], fx.AS_OF)) == rows(
        kpi.top_ip_countries(views, star.dim_location(enriched), fx.AS_OF)
    )


def test_product_hours_without_views_are_zero(spark, stored):
    fact = wh.read_warehouse(spark, stored)[FACT]
    empty = kpi.product_hourly(fact, -1, dt.date(2031, 5, 6))
    assert rows(empty) == {(hour, 0) for hour in range(24)}


def test_events_without_optional_columns(spark):
    """A source that never sends the viewed product still gives a star."""
    given = spark.createDataFrame(
        [("1", "view_product_detail", "4", 3600)],
        "id string, collection string, product_id string, time_stamp bigint",
    )
    assert set(EVENT.fieldNames()) <= set(with_columns_of(given, EVENT).columns)
    assert rows(enrich(given).select("event_id", "product_id", "browser")) == {("1", 4, "Unknown")}


def test_place_written_alike_is_one_location(spark):
    """The key joins the names without a mark between them; what collides is one row."""
    given = spark.createDataFrame(
        [("ab", "c", "d"), ("a", "bc", "d")], "city string, region string, country string"
    )
    assert star.dim_location(given).count() == 1


def test_star_join_keeps_every_event(spark, stored):
    tables = wh.read_warehouse(spark, stored)
    joined = star.star_join(tables)
    assert joined.count() == tables[FACT].count()
    assert joined.where("product_id IS NOT NULL AND product_name IS NULL").isEmpty()
