import datetime as dt

from hourmill.plans.pipeline import read_gold, run
from hourmill.plans.silver import read_silver
from hourmill.spec import default_spec
from hourmill.streaming.ingest import run_streaming

from test_pipeline import RULES, _gold, _hours, _land


def test_file_stream_ingests_only_new_snapshots_and_matches_batch(spark, scratch):
    t0 = dt.datetime(2024, 1, 10, 0, 0)
    day1 = {t: float(i % 4) for i, t in enumerate(_hours(t0, 20))}
    day2 = {t: float(i % 3) + 0.5 for i, t in enumerate(_hours(t0 + dt.timedelta(hours=15), 20))}

    spec = default_spec(scratch + "/s", dt.date(2024, 1, 11), "incremental", rules=RULES)
    ckpt = scratch + "/s/_streams"
    _land(spark, spec, dt.date(2024, 1, 11), day1)
    first, _ = run_streaming(spark, spec, ckpt)
    assert [p.rows for p in first] == [20, 20, 20]
    _land(spark, spec, dt.date(2024, 1, 12), day2)
    second, gold = run_streaming(spark, spec, ckpt)
    assert [p.rows for p in second] == [20, 20, 20]  # only the new snapshot was read
    assert gold.start is not None
    energy = {r.timestamp: r.price for r in read_silver(spark, spec.dataset("energy").silver).collect()}
    assert len(energy) == 35 and energy[t0 + dt.timedelta(hours=15)] == 0.5

    full = default_spec(scratch + "/f", dt.date(2024, 1, 12), "full_refresh", rules=RULES)
    _land(spark, full, dt.date(2024, 1, 11), day1)
    _land(spark, full, dt.date(2024, 1, 12), day2)
    run(spark, full)
    assert _gold(spark, spec) == _gold(spark, full)
    assert read_gold(spark, spec).count() == 35


def test_replayed_micro_batch_leaves_tables_unchanged(spark, scratch):
    """A crash after the upsert but before the stream's commit replays the
    batch on restart (its commit-log entry is missing); the idempotent
    upsert leaves silver and gold as they were."""
    import glob
    import os

    t0 = dt.datetime(2024, 1, 10, 0, 0)
    spec = default_spec(scratch + "/r", dt.date(2024, 1, 11), "incremental", rules=RULES)
    ckpt = scratch + "/r/_streams"
    _land(spark, spec, dt.date(2024, 1, 11), {t: float(i % 5) for i, t in enumerate(_hours(t0, 24))})
    run_streaming(spark, spec, ckpt)
    silver_before = sorted(read_silver(spark, spec.dataset("energy").silver).collect())
    gold_before = _gold(spark, spec)

    from urllib.parse import urlparse

    local = urlparse(ckpt).path  # the test's checkpoint root is a file: URI
    commits = glob.glob(f"{local}/*/commits/*") + glob.glob(f"{local}/*/commits/.*.crc")
    assert commits
    for f in commits:
        os.remove(f)  # simulated crash: offsets logged, commits not
    replayed, _ = run_streaming(spark, spec, ckpt)
    assert [p.batch_ids for p in replayed] == [[0], [0], [0]]
    assert sorted(read_silver(spark, spec.dataset("energy").silver).collect()) == silver_before
    assert _gold(spark, spec) == gold_before
