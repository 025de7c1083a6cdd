"""Bronze -> silver -> gold on hand-made snapshots (edge rows of FIXTURES.md)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourmill.functions.timekeys import snapshot_name
from hourmill.plans.gold import GoldRules
from hourmill.plans.pipeline import read_gold, run
from hourmill.plans.runlog import run_summary
from hourmill.plans.silver import read_silver
from hourmill.sources.snapshots import (
    ENERGY_SCHEMA,
    SNAPSHOT_COL,
    WEATHER_SCHEMA,
    AIR_SCHEMA,
    land_snapshots,
    read_incremental,
)
from hourmill.spec import default_spec

RULES = GoldRules(rolling_hours=3, wind_threshold=6.0)


def _hours(start, n):
    return [start + dt.timedelta(hours=i) for i in range(n)]


def _land(spark, spec, run_date, prices, wind=None, air=None):
    """One snapshot per feed; ``prices``: {utc datetime: price}; weather/air in Amsterdam wall time."""
    name = snapshot_name(run_date, spec.extract_days)
    recs = [(p, t.strftime("%Y-%m-%dT%H:%M:%SZ")) for t, p in sorted(prices.items())]
    e = spark.createDataFrame([(recs, 0.0, "x", "y", 4)], ENERGY_SCHEMA).withColumn(SNAPSHOT_COL, F.lit(name))
    land_snapshots(e, spec.dataset("energy").bronze)
    wind = wind if wind is not None else {t: 7.0 for t in prices}
    local = [(t + dt.timedelta(hours=1)).strftime("%Y-%m-%dT%H:%M") for t in sorted(wind)]  # January: UTC+1
    vals = [wind[t] for t in sorted(wind)]
    w = spark.createDataFrame([(52.0, 4.9, "Europe/Amsterdam", (local, vals, vals, vals))], WEATHER_SCHEMA)
    land_snapshots(w.withColumn(SNAPSHOT_COL, F.lit(name)), spec.dataset("weather").bronze)
    air = air if air is not None else {t: 1.0 for t in prices}
    local = [(t + dt.timedelta(hours=1)).strftime("%Y-%m-%dT%H:%M") for t in sorted(air)]
    vals = [air[t] for t in sorted(air)]
    a = spark.createDataFrame([(52.0, 4.9, "Europe/Amsterdam", (local, vals, vals, vals))], AIR_SCHEMA)
    land_snapshots(a.withColumn(SNAPSHOT_COL, F.lit(name)), spec.dataset("air_quality").bronze)


def _gold(spark, spec):
    cols = ["timestamp", "price", "avg_price_last_3h", "pct_vs_3h_avg", "wx_wind_speed_10m", "label"]
    return sorted(tuple(r) for r in read_gold(spark, spec).select(*cols).collect())


def test_newest_snapshot_wins_and_silver_is_keyed(spark, scratch):
    spec = default_spec(scratch, dt.date(2024, 1, 11), "full_refresh", rules=RULES)
    t0 = dt.datetime(2024, 1, 10, 0, 0)
    _land(spark, spec, dt.date(2024, 1, 10), {t: 10.0 for t in _hours(t0, 6)})
    _land(spark, spec, dt.date(2024, 1, 11), {t0 + dt.timedelta(hours=5): 99.0})
    run(spark, spec)
    silver = read_silver(spark, spec.dataset("energy").silver)
    assert silver.columns == ["timestamp", "price", "date", "hk"]
    got = {r.timestamp: r.price for r in silver.collect()}
    assert len(got) == 6 and got[t0 + dt.timedelta(hours=5)] == 99.0 and got[t0] == 10.0


def test_incremental_equals_full_refresh_with_old_correction(spark, scratch):
    t0 = dt.datetime(2024, 1, 10, 0, 0)
    day1 = {t: float(i % 5) for i, t in enumerate(_hours(t0, 30))}
    # Next fetch: new hours plus a correction 20 h before the high-water mark (older than the 6 h overlap).
    day2 = {t: float((i * 7) % 11) for i, t in enumerate(_hours(t0 + dt.timedelta(hours=30), 20))}
    day2[t0 + dt.timedelta(hours=9)] = 42.0
    wind2 = {t: 7.0 for t in day2}
    wind2[t0 + dt.timedelta(hours=10)] = 1.0  # late wind correction as well

    inc_root, full_root = scratch + "/inc", scratch + "/full"
    inc = default_spec(inc_root, dt.date(2024, 1, 11), "incremental", rules=RULES)
    _land(spark, inc, dt.date(2024, 1, 11), day1)
    run(spark, inc)
    _land(spark, inc, dt.date(2024, 1, 12), day2, wind=wind2)
    silver, gold = run(spark, inc.but(run_date=dt.date(2024, 1, 12)))
    assert gold.start == t0 + dt.timedelta(hours=9)  # recompute reaches back to the correction

    full = default_spec(full_root, dt.date(2024, 1, 12), "full_refresh", rules=RULES)
    _land(spark, full, dt.date(2024, 1, 11), day1)
    _land(spark, full, dt.date(2024, 1, 12), day2, wind=wind2)
    run(spark, full)
    assert _gold(spark, inc) == _gold(spark, full)

    # Same batch again: nothing changes.
    before = _gold(spark, inc)
    run(spark, inc.but(run_date=dt.date(2024, 1, 12)))
    assert _gold(spark, inc) == before

    summary = {(r.level, r.step): r.n_events for r in run_summary(spark, inc.log_path).collect()}
    assert summary[("INFO", "start")] == 3 and summary[("INFO", "end")] == 3


def test_failed_gold_leaves_its_events_in_the_log(spark, scratch):
    from hourmill.plans.runlog import read_log

    spec = default_spec(scratch, dt.date(2024, 1, 10), "full_refresh", rules=GoldRules(price="no_such_column"))
    _land(spark, spec, dt.date(2024, 1, 10), {t: 1.0 for t in _hours(dt.datetime(2024, 1, 10), 4)})
    with pytest.raises(ValueError, match="no_such_column"):
        run(spark, spec)
    rows = read_log(spark, spec.log_path).collect()
    steps = {(r.level, r.step) for r in rows}
    assert {("INFO", "start"), ("INFO", "read"), ("INFO", "write_done"), ("ERROR", "gold")} <= steps
    assert ("INFO", "end") not in steps
    assert "no_such_column" in next(r.extra_json for r in rows if r.level == "ERROR")


def _two_fetches(spark, root, correction_hours_back):
    """A first run over 21 days, then a landed fetch that corrects one hour so long before the high-water mark."""
    t0, n = dt.datetime(2024, 1, 1, 0, 0), 21 * 24
    spec = default_spec(root, dt.date(2024, 1, 21), "incremental", rules=RULES)
    prices = {t: float(i % 7) for i, t in enumerate(_hours(t0, n))}
    _land(spark, spec, dt.date(2024, 1, 21), prices)
    run(spark, spec)
    at = t0 + dt.timedelta(hours=n - 1 - correction_hours_back)
    _land(spark, spec, dt.date(2024, 1, 22), {at: 99.0})
    return spec.but(run_date=dt.date(2024, 1, 22)), at


def _full(spark, spec):
    """Gold of the same silver, from nothing."""
    from dataclasses import replace

    from hourmill.plans.pipeline import build_gold

    again = spec.but(load_mode="full_refresh", gold=replace(spec.gold, path=spec.gold.path + "-full"), pending_path=None)
    build_gold(spark, again)
    return _gold(spark, again)


@pytest.mark.parametrize("hours_back", [480, 481 - 21, 30])
def test_one_correction_rewrites_at_most_two_dates(spark, scratch, hours_back):
    spec, at = _two_fetches(spark, scratch, hours_back)
    silver, gold = run(spark, spec)
    assert [(s.dataset, s.written.changed, s.written.rewritten) for s in silver if s.dataset == "energy"] == [("energy", 1, 1)]
    assert gold.start == at and 1 <= gold.rewritten <= 2
    assert _gold(spark, spec) == _full(spark, spec)


def test_failed_gold_is_made_up_by_the_next_run(spark, scratch):
    from dataclasses import replace

    from hourmill.plans.pending import outstanding, pending_rows

    spec, at = _two_fetches(spark, scratch, 300)
    broken = spec.but(gold=replace(spec.gold, rules=GoldRules(price="no_such_column")))
    with pytest.raises(ValueError, match="no_such_column"):
        run(spark, broken)
    assert outstanding(spark, spec.pending_path).hours["energy"] == {int((at - dt.datetime(1970, 1, 1)).total_seconds()) // 3600}
    assert [(r.feed, r.day, r.version) for r in pending_rows(spark, spec.pending_path).where("feed = 'energy'").collect()] == [
        ("energy", at.date().isoformat(), "2024-01-15_2024-01-22")
    ]
    silver, gold = run(spark, spec)  # the same fetch: silver does not change any more
    assert [s.written.changed for s in silver] == [0, 0, 0] and gold.start == at
    assert _gold(spark, spec) == _full(spark, spec)
    assert outstanding(spark, spec.pending_path).files == [] and pending_rows(spark, spec.pending_path).count() == 0
    # A full refresh that fails leaves all of gold to do.
    with pytest.raises(ValueError):
        run(spark, broken.but(load_mode="full_refresh"))
    assert outstanding(spark, spec.pending_path).everything
    _, gold = run(spark, spec)
    assert gold.start is None and _gold(spark, spec) == _full(spark, spec)


def test_a_change_noted_while_gold_runs_stays_pending(spark, scratch):
    from hourmill.plans import pending

    pending.note(spark, scratch, "energy", [(dt.date(2024, 1, 2), 1 << 3)])
    seen = pending.outstanding(spark, scratch)
    pending.note(spark, scratch, "air_quality", [(dt.date(2024, 1, 2), 1 << 4)])
    pending.settle(spark, seen)
    assert set(pending.outstanding(spark, scratch).hours) == {"air_quality"}


def test_hours_that_changes_reach():
    from hourmill.plans.pending import days_of, dirty_hours, intervals

    found = dirty_hours({"energy": {22, 100}, "weather": {7, 101}}, "energy", 3)
    assert intervals(found) == [(7, 7), (22, 25), (100, 103)]
    assert days_of(found) == [dt.date(1970, 1, 1), dt.date(1970, 1, 2), dt.date(1970, 1, 5)]


def test_older_run_changes_nothing_newer(spark, scratch):
    t0 = dt.datetime(2024, 1, 10, 0, 0)
    spec = default_spec(scratch, dt.date(2024, 1, 12), "incremental", rules=RULES)
    _land(spark, spec, dt.date(2024, 1, 12), {t: 5.0 for t in _hours(t0, 10)})
    run(spark, spec)
    before = _gold(spark, spec)
    _land(spark, spec, dt.date(2024, 1, 11), {t: 1.0 for t in _hours(t0, 10)})
    silver, _ = run(spark, spec.but(run_date=dt.date(2024, 1, 11)))
    assert [s.written.changed for s in silver] == [0, 0, 0] and _gold(spark, spec) == before
    rows = read_silver(spark, spec.dataset("energy").silver, versions=True)
    assert {r.snapshot for r in rows.collect()} == {"2024-01-05_2024-01-12"}


def test_another_hash_column_and_until(spark, scratch):
    t0 = dt.datetime(2024, 1, 10, 0, 0)
    spec = default_spec(scratch, dt.date(2024, 1, 11), "incremental", rules=RULES).but(hash_col="row_hash")
    _land(spark, spec, dt.date(2024, 1, 10), {t: 5.0 for t in _hours(t0, 5)})
    _land(spark, spec, dt.date(2024, 1, 11), {t: 6.0 for t in _hours(t0, 5)})
    silver, _ = run(spark, spec.but(until=snapshot_name(dt.date(2024, 1, 10))))
    assert all(s.fallback for s in silver)  # the run date's own snapshot is out of bounds
    assert {r[1] for r in _gold(spark, spec)} == {5.0}
    assert not [c for c in read_gold(spark, spec).columns if "row_hash" in c or "snapshot" in c]
    assert read_silver(spark, spec.dataset("energy").silver, hash_col="row_hash").columns == ["timestamp", "price", "date", "row_hash"]
    run(spark, spec)
    assert {r[1] for r in _gold(spark, spec)} == {6.0}


def test_managed_gold(spark, scratch):
    from hourmill.plans.gold import gold_columns
    from hourmill.sinks.tables import is_managed

    t0 = dt.datetime(2024, 1, 10, 0, 0)
    name = "managed_gold_" + scratch.rsplit("-", 1)[-1]
    spec = default_spec(scratch, dt.date(2024, 1, 10), "full_refresh", rules=RULES, gold_table=name)
    spark.sql(f"CREATE TABLE {name} (timestamp timestamp, price double, date date) USING parquet PARTITIONED BY (date)")
    _land(spark, spec, dt.date(2024, 1, 10), {t: 1.0 + i for i, t in enumerate(_hours(t0, 30))})
    run(spark, spec)
    assert is_managed(spark, name) and spark.table(name).count() == 30
    _land(spark, spec, dt.date(2024, 1, 11), {t0 + dt.timedelta(hours=2): 9.0, t0 + dt.timedelta(hours=30): 3.0})
    run(spark, spec.but(load_mode="incremental", run_date=dt.date(2024, 1, 11)))
    wanted = gold_columns(RULES, ["temperature_2m", "wind_speed_10m", "direct_radiation"], ["carbon_monoxide", "nitrogen_dioxide", "pm10"], ["timestamp"])
    assert spark.table(name).columns == [*wanted, "date"] and spark.table(name).count() == 31
    assert _gold(spark, spec) == _full(spark, spec.but(gold=spec.gold.__class__(path=scratch + "/x", rules=RULES)))
    spark.sql(f"DROP TABLE {name}")


def test_metrics_of_a_run(spark, scratch):
    from hourmill.sinks.metrics import write_metrics

    spec = default_spec(scratch, dt.date(2024, 1, 10), "full_refresh", rules=RULES).but(metrics_path=scratch + "/ops/metrics")
    _land(spark, spec, dt.date(2024, 1, 10), {t: 1.0 for t in _hours(dt.datetime(2024, 1, 10), 4)})
    run(spark, spec)
    got = {(r.table_name.rsplit("/", 1)[-1], r.mode, r.batch_rows) for r in write_metrics(spark, spec.metrics_path).collect()}
    assert got == {(t, "full_refresh", 4) for t in ("weather", "air_quality", "energy", "hourly_prices")}


def test_missing_run_date_snapshot_falls_back_to_all(spark, scratch):
    spec = default_spec(scratch, dt.date(2024, 1, 11), rules=RULES)
    _land(spark, spec, dt.date(2024, 1, 10), {dt.datetime(2024, 1, 10, 0, 0): 1.0})
    ds = spec.dataset("energy")
    df, fell_back = read_incremental(spark, ds.bronze, dt.date(2024, 1, 10), ds.schema)
    assert not fell_back and df.count() == 1
    df, fell_back = read_incremental(spark, ds.bronze, dt.date(2024, 1, 11), ds.schema)
    assert fell_back and df.count() == 1


def test_gold_catalog_table(spark, scratch):
    name = "gold_" + scratch.rsplit("-", 1)[-1]
    spec = default_spec(scratch, dt.date(2024, 1, 10), "full_refresh", rules=RULES, gold_table=name)
    _land(spark, spec, dt.date(2024, 1, 10), {t: 1.0 for t in _hours(dt.datetime(2024, 1, 10), 4)})
    run(spark, spec)
    assert spark.sql(f"SELECT count(*) AS n FROM {name}").collect()[0].n == 4


def test_log_table_and_events(spark, scratch):
    from hourmill.plans.runlog import LOG_SCHEMA, append_events, ensure_event_table, read_log, recorded

    name = "log_" + scratch.rsplit("-", 1)[-1]
    ensure_event_table(spark, name, scratch + "/log")
    ensure_event_table(spark, name, scratch + "/log")  # nothing to do
    with recorded(spark, scratch + "/log", name, {"logger": "t", "run_date": "2024-01-20"}) as log:
        log("read", "one", "energy", "warning", path='say "x"', rows=3, nothing=None)
        log("s", "b", level="debug")  # levels are stored upper-cased, as given
    with pytest.raises(KeyError):
        with recorded(spark, scratch + "/log", name, {"logger": "t"}) as log:
            log.phase = "gold"
            raise KeyError("gone")
    with recorded(spark, scratch + "/log", name):
        pass  # no events: nothing is written
    rows = spark.table(name).collect()
    assert spark.table(name).schema == LOG_SCHEMA and len(rows) == 3
    assert {(r.level, r.step, r.logger, r.run_date) for r in rows} == {
        ("WARNING", "read", "t", "2024-01-20"), ("DEBUG", "s", "t", "2024-01-20"), ("ERROR", "gold", "t", "")
    }
    assert sorted(r.extra_json for r in rows if r.level != "ERROR") == ['{"path":"say \\"x\\"","rows":"3"}', "{}"]
    frame = spark.createDataFrame([("x", None), ("y", {"a": "é"})], "step string, extra map<string,string>")
    append_events(frame, scratch + "/other", constants={"level": "INFO"})
    assert {(r.step, r.level, r.extra_json) for r in read_log(spark, scratch + "/other").collect()} == {("x", "INFO", "{}"), ("y", "INFO", '{"a":"é"}')}


def test_run_writes_a_catalog_log(spark, scratch):
    name = "runs_" + scratch.rsplit("-", 1)[-1]
    spec = default_spec(scratch, dt.date(2024, 1, 10), "full_refresh", rules=RULES).but(log_table=name)
    _land(spark, spec, dt.date(2024, 1, 10), {t: 1.0 for t in _hours(dt.datetime(2024, 1, 10), 4)})
    run(spark, spec)
    run(spark, spec.but(load_mode="incremental"))
    assert spark.sql(f"SELECT count(*) AS n FROM {name} WHERE step = 'end'").first().n == 2


def test_spring_gap_keeps_one_row_deterministically(spark):
    from hourmill.plans.silver import silver_frame

    spec = default_spec("unused", dt.date(2024, 3, 31))
    ds = spec.dataset("weather")
    times = ["2024-03-31T01:00", "2024-03-31T02:00", "2024-03-31T03:00", "xx"]
    doc = (52.0, 4.9, "Europe/Amsterdam", (times, [1.0, 2.0, 3.0, 4.0], [5.0, 6.0, 7.0, 8.0], [0.0, 0.0, 0.0, 0.0]))
    raw = spark.createDataFrame([doc], WEATHER_SCHEMA)
    for shuffle in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
        rows = sorted((r.timestamp, r.temperature_2m) for r in silver_frame(raw, ds).collect())
        # 01:00 local -> 00:00 UTC; 02:00 and 03:00 local both -> 01:00 UTC; "xx" dropped
        assert rows == [(dt.datetime(2024, 3, 31, 0, 0), 1.0), (dt.datetime(2024, 3, 31, 1, 0), 3.0)]
    spark.conf.set("spark.sql.shuffle.partitions", "8")
