import json
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tapeloom import session
from tapeloom.plans import refresh
from tapeloom.schemas import TABLES
from tapeloom.sources import layout as store
from tapeloom.sources import snapshots
from tapeloom.sources.dimensions import dimension
from tests.helpers import FILL, LIVE, ORDER, TICK, by, table, ts

NOW = "2024-01-02 23:00:00"


@pytest.fixture
def place(tmp_path):
    return store.Layout(str(tmp_path / "desk"))


def test_schemas_are_declared(spark):
    for name, spec in TABLES.items():
        columns = set(spec.columns)
        assert columns >= {*spec.keys, *spec.not_null, *spec.domains, *spec.defaults}, name
        assert spec.day_of is None or spec.day_of in columns
    for bronze in ("raw_market_data", "raw_orders", "raw_executions"):
        assert not any(f.nullable for f in TABLES[bronze].schema)


def test_rows_with_quotes_and_required_columns(spark, place):
    rows = [dict(instrument_id=f"it's \"{i}\"", type="FUTURES", underlying="SPY") for i in range(450)]
    assert store.append_rows(spark, place, "hedge_instruments", rows) == 450
    back = store.read_table(spark, place, "hedge_instruments")
    assert back.count() == 450 and back.where("strike IS NULL").count() == 450
    assert back.where(F.col("instrument_id") == "it's \"7\"").count() == 1
    with pytest.raises(PySparkException):
        store.append_rows(spark, place, "raw_orders", [dict(order_id="a")])


def test_bronze_appends_conform_to_the_declared_types(spark, place):
    wide = table(spark, "raw_orders", [dict(order_id="a")], **ORDER).withColumn("qty", F.lit(5).cast("long"))
    store.write_table(wide.select(*reversed(wide.columns)), place, "raw_orders")
    store.write_table(wide, place, "raw_orders")
    back = store.read_table(spark, place, "raw_orders")
    assert back.count() == 2 and back.columns == TABLES["raw_orders"].columns
    assert dict(back.dtypes)["qty"] == "int"


def test_time_travel_by_day_prunes_folders(spark, place):
    ticks = table(spark, "raw_market_data", [
        dict(event_id=str(d), event_time=ts(f"2024-01-0{d} 10:00:00")) for d in range(1, 6)], **TICK)
    store.write_table(ticks, place, "raw_market_data")
    recent = store.read_table(spark, place, "raw_market_data", since="2024-01-04 10:00:00")
    assert sorted(r.event_id for r in recent.collect()) == ["4", "5"]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_time_day" in plan
    with pytest.raises(ValueError):
        store.read_table(spark, place, "raw_market_data").transform(
            lambda df: store._since(df, TABLES["raw_orders"], NOW))


def test_versions(spark, place):
    live = table(spark, "live_orders", [dict(order_id="a")], **LIVE)
    assert not store.table_exists(spark, place, "live_orders")
    with pytest.raises(FileNotFoundError):
        store.read_table(spark, place, "live_orders")
    assert [store.write_version(live.withColumn("qty", F.lit(i)), place, "live_orders") for i in range(4)] == [
        0, 1, 2, 3]
    # A version without its success marker is not visible.
    Path(place.version("live_orders", 9)).mkdir()
    assert store.versions(spark, place, "live_orders") == [0, 1, 2, 3]
    assert store.read_table(spark, place, "live_orders").first().qty == 3
    assert store.read_table(spark, place, "live_orders", version=1).first().qty == 1
    assert store.drop_old_versions(spark, place, "live_orders", keep=2) == [0, 1]
    assert store.versions(spark, place, "live_orders") == [2, 3]


def test_a_retried_batch_replaces_itself(spark, place):
    fills = table(spark, "executions_silver", [dict(exec_id="a", fill_qty=1)])
    for batch in (0, 1, 1):
        store.write_batch(fills, place, "executions_silver", batch)
    assert store.read_table(spark, place, "executions_silver").count() == 2
    with pytest.raises(ValueError):
        store.write_table(fills, place, "executions_silver")
    store.write_table(fills, place, "executions_silver", mode="overwrite")
    assert store.read_table(spark, place, "executions_silver").count() == 1


def test_first_available(spark, place):
    fallback = table(spark, "raw_orders", [dict(order_id="a")], **ORDER)
    assert store.first_available(
        lambda: store.available(spark, place, "raw_orders"), lambda: fallback) is fallback
    store.write_table(fallback, place, "raw_orders")
    assert store.first_available(
        lambda: store.available(spark, place, "raw_orders"), lambda: fallback) is not fallback
    with pytest.raises(LookupError):
        store.first_available(lambda: None)
    with pytest.raises(ZeroDivisionError):
        store.first_available(lambda: 1 / 0, lambda: fallback)


def test_sql_over_tables(spark, place):
    store.write_table(dimension(spark, "traders"), place, "traders")
    assert store.register_tables(spark, place) == ["traders"]
    named = store.run_sql(spark, "SELECT name FROM traders WHERE desk = :desk ORDER BY name",
                          {"desk": "ETF Execution"})
    assert [r.name for r in named.collect()] == ["Alex Chen", "David Liu", "James Park"]
    df = spark.range(3)
    assert store.run_sql(spark, "SELECT count(*) AS n FROM {t}", t=df).first().n == 3


def test_row_counts(spark):
    counts = store.table_row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert {r.table_name: r.row_count for r in counts.collect()} == {"a": 3, "b": 0}


def test_bucketed_tables_join_without_a_shuffle(spark, place):
    orders = table(spark, "raw_orders", [dict(order_id=f"O{i}") for i in range(50)], **ORDER)
    fills = table(spark, "raw_executions", [dict(exec_id=str(i), order_id=f"O{i % 60}") for i in range(200)], **FILL)
    o = store.save_bucketed(orders, place, "raw_orders", buckets=4)
    x = store.save_bucketed(fills, place, "raw_executions", buckets=4)
    joined = x.join(o.hint("merge"), "order_id", "left").groupBy("order_id").count()
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 60


def test_market_snapshot_files(spark, tmp_path):
    snap = table(spark, "market_snapshot_gold", [
        dict(ticker="SPY", last_price=1.5, bid=1.0, ask=2.0, volume=3, vwap=1.25, intraday_high=2.0),
        dict(ticker="QQQ", last_price=9.0)])
    path = str(tmp_path / "snap")
    snapshots.market_snapshot_json(snap, path, NOW)
    files = sorted(Path(path).glob("symbol=*/*.json"))
    assert [f.parent.name for f in files] == ["symbol=QQQ", "symbol=SPY"]
    spy = json.loads(files[1].read_text())
    assert spy["ticker"] == "SPY" and spy["intraday_low"] is None and spy["vwap"] == 1.25
    rows = by(snapshots.read_market_snapshot_json(spark, path), "ticker")
    assert rows["SPY"].generated_at == ts(NOW) and rows["QQQ"].bid is None


def test_order_summary(spark, tmp_path):
    orders = table(spark, "raw_orders", [dict(order_id="a"), dict(order_id="b", status="FILLED")], **ORDER)
    fills = table(spark, "raw_executions", [dict(exec_id="x")] * 3, **FILL)
    summary = snapshots.order_summary(orders, fills, NOW)
    snapshots.order_summary_json(summary, str(tmp_path / "summary"))
    (file,) = Path(tmp_path / "summary").glob("*.json")
    assert json.loads(file.read_text()) == {
        "generated_at": "2024-01-02T23:00:00.000Z", "total_orders": 2, "total_executions": 3,
        "status_counts": {"PENDING": 1, "PARTIAL": 0, "FILLED": 1, "CANCELLED": 0}}


def test_scratch_is_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_dir(spark, "x").startswith(f"{shared}/x-")
    assert session.scratch_dir(spark, "x") != session.scratch_dir(spark, "x")


def test_rebuild_and_sync(spark, place):
    store.write_table(dimension(spark, "etf_reference"), place, "etf_reference")
    store.write_table(table(spark, "raw_orders", [dict(order_id="O1")], **ORDER), place, "raw_orders")
    # Only bronze exists: the live table starts from it.
    assert refresh.sync_live_table(spark, place, NOW) == 0
    assert store.read_table(spark, place, "live_orders").first().etf_name is None
    store.write_table(table(spark, "raw_executions", [dict(exec_id="x")], **FILL), place, "raw_executions")
    store.write_table(table(spark, "raw_market_data", [dict(event_id="e")], **TICK), place, "raw_market_data")
    assert [tuple(r) for r in refresh.current_prices(spark, place).collect()] == [("SPY", 100.0)]
    refresh.rebuild_silver(spark, place, NOW)
    refresh.rebuild_gold(spark, place, NOW)
    assert store.read_table(spark, place, "trading_performance_gold").first().total_orders == 1
    assert refresh.sync_live_table(spark, place, NOW) == 1
    row = store.read_table(spark, place, "live_orders").first()
    assert (row.filled_qty, row.fill_rate) == (10, 0.1)
    assert refresh.current_prices(spark, place).first().last_price == 100.0


def test_a_version_made_meanwhile_is_not_replaced(spark, tmp_path, monkeypatch):
    place = store.Layout(str(tmp_path / "race"))
    live = table(spark, "live_orders", [dict(order_id="O1")], **LIVE)
    store.write_version(live, place, "live_orders")
    adjusted = live.withColumn("qty", F.lit(777))
    conform = store.conform

    def slow(df, name):  # while the sync is made, a batch of actions commits the same version
        monkeypatch.setattr(store, "conform", conform)
        store.write_version(adjusted, place, "live_orders", 1, writer="actions/0")
        return conform(df, name)

    monkeypatch.setattr(store, "conform", slow)
    with pytest.raises(RuntimeError, match="another writer"):
        store.write_version(live, place, "live_orders")
    assert store.versions(spark, place, "live_orders") == [0, 1]
    assert store.read_table(spark, place, "live_orders").first().qty == 777
    assert store.write_version(live, place, "live_orders") == 2
