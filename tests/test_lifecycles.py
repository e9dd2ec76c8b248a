"""Shifts, couriers and orders followed over streams, by hand-fed batches."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from tests.test_streaming import two_feeds
from zonepulse import MetricConfig
from zonepulse.operators import couriers, kpis, lifecycles, quality
from zonepulse.session import streaming_session
from zonepulse.sinks.manifest import Folder
from zonepulse.streaming.jobs import JOBS
from zonepulse.streaming.late import WINDOWED, LateRows


@pytest.fixture
def run(spark, tmp_path):
    """Feed a metric in steps of rows; each row knows its arrival step."""
    session = streaming_session(spark, 2)
    return lambda name, steps, cfg=MetricConfig(): two_feeds(spark, session, tmp_path, name, steps, cfg)


def test_a_shift_ends_at_offline_or_in_silence(run, raw_orders, raw_couriers):
    none = raw_orders().limit(0)

    def row(session, minute, status="ONLINE_IDLE", **more):
        return {"active_session_id": session, "event_time": at(minute), "status": status,
                "event_id": f"{session}{minute}", "session_start_time": at(0), **more}

    steps = [
        [row("a", 10), row("a", 30), row("b", 5), row("c", 20), row(None, 20)],
        [row("a", 60, "OFFLINE"), row("b", 40, "OFFLINE"), row("a", 58)],    # 58 arrives after 60
        [row("b", 100)],                                                     # back in the same shift
        [row("d", 60 * 10)],                                                 # a, closed, lingered out
        [row("d", 60 * 30)],                                                 # b and c fell silent
        [row("e", 60 * 31)],
    ]
    frames = [raw_couriers(*rows) for rows in steps]
    table = run("shift_sessions", [(none, f) for f in frames])
    got = {r.active_session_id: r for r in table.collect()}
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f)
    want = {r.active_session_id: r for r in couriers.sessions(quality.clean(whole)).collect()}
    assert got.keys() == want.keys()
    for key, r in want.items():
        assert {c: got[key][c] for c in r.asDict()} == r.asDict()
    assert {k: r.is_over for k, r in got.items()} == {
        "a": True, "b": True, "c": True, "d": False, "e": False}
    assert got["a"].is_closed and not got["c"].is_closed


def test_the_row_before_may_arrive_after(run, raw_orders, raw_couriers):
    none = raw_orders().limit(0)

    def row(minute, battery, status="ONLINE_IDLE", courier="c1", **more):
        return {"courier_id": courier, "event_time": at(minute), "battery_pct": battery,
                "status": status, "event_id": f"{courier}-{minute}-{battery}", **more}

    frames = [raw_couriers(*rows) for rows in (
        [row(1, 50), row(4, 30, "OFFLINE"), row(2, 5, courier="c2")],
        [row(3, 9), row(4, 4, "OFFLINE", "c2", speed_kmh=300.0)],             # 3 comes before 4
        [row(5, None), row(6, 3, "OFFLINE"), row(6, 8, "OFFLINE", "c2")],
        [row(30, 80, location_accuracy_meters=500.0)],
        [row(60, 80)], [row(90, 1)])]
    got = {r.event_id: r.quality_flags for r in run(
        "courier_quality_flags", [(none, f) for f in frames]).collect()}
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f)
    want = {r.event_id: r.quality_flags
            for r in couriers.quality_flags(quality.clean(whole)).collect()}
    assert got == want == {
        "c1-4-30": "LOW_BATTERY_OFFLINE", "c2-4-4": "IMPOSSIBLE_SPEED, LOW_BATTERY_OFFLINE",
        "c2-6-8": "LOW_BATTERY_OFFLINE", "c1-30-80": "POOR_ACCURACY"}


def test_an_order_is_told_when_it_is_over(run, raw_orders, raw_couriers):
    none = raw_couriers().limit(0)

    def row(order, status, minute):
        return {"order_id": order, "status": status, "event_time": at(minute),
                "event_id": f"{order}{status}{minute}"}

    frames = [raw_orders(*rows) for rows in (
        [row("whole", "PLACED", 0), row("no pickup", "PLACED", 0), row("lost", "PLACED", 1)],
        [row("whole", "DELIVERED", 40), row("whole", "PICKED_UP", 38),
         row("no pickup", "READY_FOR_PICKUP", 39), row("no pickup", "DELIVERED", 41)],
        [row("whole", "READY_FOR_PICKUP", 37)],                                # late, but in time
        [row("fresh", "PLACED", 60)], [row("fresh", "READY_FOR_PICKUP", 61)],
        [row("open", "PLACED", 500)], [row("open", "PICKED_UP", 501)])]
    got = sorted(run("order_durations", [(f, none) for f in frames]).collect())
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f)
    want = sorted(r for r in kpis.order_durations(quality.clean(whole)).collect() if r.order_id != "open")
    assert got == want
    assert {r.order_id: r.ready_to_pickup_min for r in got} == {
        "whole": 1.0, "no pickup": None, "lost": None, "fresh": None}


def test_surge_looks_back_over_windows_that_were_told_before(run, raw_orders, raw_couriers):
    def orders(minute, n, **more):
        return [{"order_id": f"o{minute}-{i}", "event_id": f"o{minute}-{i}", "event_time": at(minute), **more}
                for i in range(n)]

    def idle(minute, n):
        return [{"courier_id": f"c{i}", "event_id": f"c{minute}-{i}", "event_time": at(minute)}
                for i in range(n)]

    steps = [(raw_orders(*orders(1, 2)), raw_couriers(*idle(1, 1))),
             (raw_orders(*orders(11, 2), *orders(1, 1, status="CONFIRMED")), raw_couriers(*idle(12, 4))),
             (raw_orders(*orders(17, 9)), raw_couriers(*idle(18, 4))),
             (raw_orders(*orders(60, 3)), raw_couriers(*idle(61, 9)))]
    got = sorted(run("surge_signal", steps).collect())
    both = [steps[0][i].unionByName(steps[1][i]).unionByName(steps[2][i]).unionByName(steps[3][i])
            for i in (0, 1)]
    want = sorted(r for r in kpis.surge_signal(*[quality.clean(b) for b in both]).collect()
                  if r.window_start < at(60).replace(tzinfo=None))
    assert got == want and [r.is_surge for r in got] == [True, False, True]


@pytest.mark.parametrize("name", sorted(WINDOWED))
def test_rows_counted_and_rows_set_aside_are_the_feed(spark, raw_orders, restaurants, tmp_path, name):
    """Batches of several files, a restart between any two, and a batch that is repeated."""
    from zonepulse.model import ORDERS
    from zonepulse.sinks.changelog import ChangelogTable
    from zonepulse.sources.files import stream_parquet
    from zonepulse.streaming.jobs import Feeds, clean_stream, start_metric

    cfg, job, inbox = MetricConfig(orders_watermark="1 second"), JOBS[name], f"{tmp_path}/in"
    session = streaming_session(spark, 2)
    status = "PLACED" if name in ("kpi_tumbling", "orders_per_minute") else "DELIVERED"
    feed = []
    late = LateRows(name, f"{tmp_path}/cp/{name}", f"{tmp_path}/late", ORDERS.schema, cfg)
    table = ChangelogTable.of(job.table, f"{tmp_path}/out/{name}")

    def write(batch, batch_id):
        table.write_batch(batch, batch_id)
        late.write(batch.sparkSession, batch_id)
        late.write(batch.sparkSession, batch_id)

    for step in range(13):
        minutes = [30 * step, 30 * step + 7, max(0, 30 * step - 100)]
        rows = [{"event_id": f"{step}-{m}", "event_time": at(m), "status": status,
                 "actual_prep_minutes": 9} for m in minutes]
        feed += rows
        raw_orders(*rows).repartition(2).write.mode("append").parquet(inbox)
        stream = clean_stream(stream_parquet(session, inbox, ORDERS.schema), cfg.orders_watermark)
        start_metric(job, Feeds(stream, None, restaurants), f"{tmp_path}/out", f"{tmp_path}/cp", cfg,
                     available_now=True, write_batch=write).awaitTermination()
    count = "delivered_count" if name == "revenue_per_hour" else "order_count"
    kept = table.latest(spark).agg(F.sum(count)).first()[0]
    aside = [r.event_id for r in late.read(spark).collect()]
    assert len(aside) == len(set(aside)) > 5
    assert kept + len(aside) == len(feed)
    assert Folder(spark, f"{tmp_path}/cp/{name}").names("offsets")


class _Bucket:
    """Stands in for the state of a bucket at a watermark."""

    exists = hasTimedOut = False

    def getCurrentWatermarkMs(self):
        return 50_000

    def update(self, values):
        self.kept = values

    def setTimeoutTimestamp(self, at_ms):
        self.due_ms = at_ms


def test_one_call_follows_all_keys_of_a_bucket():
    import pandas as pd

    n = 20_000
    ids = [f"o{i}" for i in range(n)]
    rows = [pd.DataFrame({"order_id": ids, "placed": [1_000_000] * n, "ready": None, "picked_up": None,
                          "delivered": None, "last": [1_000_000] * n}),
            pd.DataFrame({"order_id": ids, "placed": None, "ready": None, "picked_up": None,
                          "delivered": range(49_990_001, 49_990_001 + n),
                          "last": range(49_990_001, 49_990_001 + n)})]
    state = _Bucket()
    told = pd.concat(lifecycles._follow_orders(3_600_000, (0,), rows, state))
    # A delivery before the watermark is told, one at or after it waits.
    assert len(told) == 9_999 and told["ready_to_pickup_min"].isna().all()
    assert len(state.kept[0]) == n - 9_999 and state.due_ms == 50_001


class _Values(dict):
    """Stands in for the state of one key: a value under ``None``, or a map."""

    def get(self, key=None):
        return dict.get(self, key)

    getValue = get

    def update(self, value):
        self[None] = value

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]


class _Handle:
    def __init__(self):
        self.states, self.timers = {}, set()

    def getValueState(self, name, *schemas):
        return self.states.setdefault(name, _Values())

    getMapState = getValueState

    def registerTimer(self, at_ms):
        self.timers.add(at_ms)

    def deleteTimer(self, at_ms):
        self.timers.remove(at_ms)


def _watermark(ms):
    from pyspark.sql.streaming.stateful_processor import TimerValues
    return TimerValues(0, ms)


def _expire(follower, handle, ms):
    """What the timers tell that a watermark of ``ms`` has reached."""
    told = []
    for timer in sorted(t for t in handle.timers if t <= ms):
        told += follower.handleExpiredTimer((0,), _watermark(ms), None)
        handle.timers.remove(timer)
    return told


@pytest.mark.parametrize("piece_rows", [100, 2_000, 100_000])
def test_no_call_or_state_holds_all_that_a_bucket_got(piece_rows):
    """Half of the rows are one courier's, and half have no courier; they come in any order."""
    import numpy as np
    import pandas as pd

    n, minute_us = 24_000, 60_000_000
    rng = np.random.default_rng(3)
    rows = pd.DataFrame({
        "bucket": 0, "courier_id": np.where(rng.random(n) < 0.5, "hot", None),
        "event_id": [f"e{i:05}" for i in range(n)], "zone_id": "Z1",
        "at": rng.integers(0, 480, n) * minute_us, "speed_kmh": rng.integers(0, 202, n) * 1.0,
        "location_accuracy_meters": np.nan, "battery_pct": rng.choice([5.0, 10.0, 11.0, np.nan], n),
        "is_offline": rng.random(n) < 0.3})
    ordered = rows.sort_values(["at", "event_id"])
    before = ordered.groupby("courier_id", dropna=False)["battery_pct"].shift().sort_index()
    fast, low = rows["speed_kmh"] >= 200, rows["is_offline"] & (before <= 10)
    want = {e: ", ".join(["IMPOSSIBLE_SPEED"] * f + ["LOW_BATTERY_OFFLINE"] * b)
            for e, f, b in zip(rows["event_id"], fast, low, strict=True) if f or b}

    seen = []

    class Watched(lifecycles.CourierRows):
        def _told(self, rows, lasts):
            seen.append(len(rows))
            return super()._told(rows, lasts)

    follower, handle = Watched(MetricConfig(), piece_rows, slot_us=10 * minute_us), _Handle()
    follower.init(handle)
    got, sizes = {}, []
    # The second batch comes after watermarks that passed part of the first.
    for batch, watermark in ((rows[rows["at"] < 300 * minute_us], 200 * 60_000),
                             (rows[rows["at"] >= 300 * minute_us], 481 * 60_000)):
        follower.handleInputRows((0,), (batch[i:i + 500] for i in range(0, len(batch), 500)), None)
        sizes += [len(lifecycles._unpacked(rows)) for rows, in handle.states["waiting"].values()]
        for ms in (watermark - 7 * 60_000, watermark):
            told = _expire(follower, handle, ms)
            assert all((t["event_timestamp"] < pd.Timestamp(ms, unit="ms")).all() for t in told)
            got |= {e: f for t in told for e, f in zip(t["event_id"], t["quality_flags"], strict=True)}
    assert got == want and len(want) > 1_000
    assert sum(seen) == n and not handle.states["waiting"] and not handle.timers
    assert max(sizes) < piece_rows + 500 and max(seen) < piece_rows + 2 * n // 48
