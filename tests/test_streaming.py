"""Streams against their SQL, replay safety, late data and the supervisor."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.compare import difference
from tests.conftest import at
from zonepulse import MetricConfig
from zonepulse.model import COURIERS, ORDERS
from zonepulse.operators import couriers, kpis, quality
from zonepulse.session import streaming_session
from zonepulse.sinks.archive import Archive
from zonepulse.sinks.batches import NUMBER, HandOver
from zonepulse.sinks.changelog import ChangelogTable
from zonepulse.sinks.manifest import Folder
from zonepulse.sources.decode import decode_json, encode_json
from zonepulse.sources.files import stream_parquet
from zonepulse.streaming.jobs import JOBS, Feeds, clean_stream, start_metric
from zonepulse.streaming.pipeline import Pipeline
from zonepulse.streaming.supervisor import supervise

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith("stream_")])
def test_stream_query(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), SQL[name], SF_DIR) == ""


class Live:
    """One metric fed by hand."""

    def __init__(self, spark, tmp_path, name, cfg=MetricConfig(), by_key=False):
        self.session, self.root = streaming_session(spark, 2), str(tmp_path)
        self.inbox, self.job, self.cfg, self.by_key = f"{tmp_path}/in", JOBS[name], cfg, by_key
        spark.createDataFrame([], ORDERS.schema).write.parquet(self.inbox)

    def feed(self, df):
        df.write.mode("append").parquet(self.inbox)
        stream = clean_stream(stream_parquet(self.session, self.inbox, ORDERS.schema),
                              self.cfg.orders_watermark, self.by_key)
        query = start_metric(self.job, Feeds(stream), f"{self.root}/out", f"{self.root}/cp",
                             self.cfg, available_now=True)
        query.awaitTermination()
        return self

    def latest(self):
        return ChangelogTable.of(self.job.table, f"{self.root}/out/{self.job.name}").latest(
            self.session)


def test_event_behind_the_watermark_is_dropped_by_the_stream_only(spark, raw_orders, tmp_path):
    first = raw_orders({"event_time": at(0)}, {"event_time": at(60)})
    late = raw_orders({"event_time": at(1), "ingestion_time": at(61)}, {"event_time": at(61)})
    live = Live(spark, tmp_path, "kpi_tumbling").feed(first).feed(late)
    streamed = {r.window_start.hour * 60 + r.window_start.minute: r.order_count
                for r in live.latest().collect()}
    assert streamed == {0: 1, 60: 2}
    whole = kpis.tumbling_kpis(quality.clean(first.unionByName(late)))
    assert {r.order_count for r in whole.collect()} == {2}


def test_slow_fraud_is_seen_across_batches(spark, raw_orders, tmp_path):
    live = Live(spark, tmp_path, "fraud_alerts")
    cancel = [{"status": "CANCELLED", "event_time": at(t), "event_id": f"x{t}"} for t in (1, 2, 3)]
    live.feed(raw_orders(*cancel[:2]))
    assert live.latest().count() == 0
    live.feed(raw_orders(cancel[2]))
    assert [r.fraud_flags for r in live.latest().collect()] == ["HIGH_CANCELLATION"]


@pytest.mark.parametrize("distinct", ["exact", "approx"])
def test_account_hopping_across_batches(spark, raw_orders, tmp_path, distinct):
    live = Live(spark, tmp_path, "fraud_alerts", MetricConfig(stream_distinct=distinct))
    for i, customer in enumerate(("u1", "u1", "u2")):
        live.feed(raw_orders({"customer_id": customer, "event_time": at(i), "event_id": f"x{i}"}))
    row = live.latest().first()
    assert (row.distinct_customer_ids, row.total_order_value) == (2, 30.0)


def test_copies_in_different_batches_count_once(spark, raw_orders, tmp_path):
    live = Live(spark, tmp_path, "kpi_tumbling", by_key=True)
    live.feed(raw_orders({"event_time": at(1), "event_id": "same"}))
    live.feed(raw_orders({"event_time": at(1), "event_id": "same", "is_duplicate": True},
                         {"event_time": at(2), "event_id": "other"}))
    assert [r.order_count for r in live.latest().collect()] == [2]


def test_failed_batch_is_repeated_without_double_counting(spark, raw_orders, tmp_path):
    """A batch that dies after its write leaves the checkpoint behind it; the restart repeats it."""
    live = Live(spark, tmp_path, "kpi_tumbling")
    live.feed(raw_orders({"event_time": at(1), "event_id": "a"}))
    raw_orders({"event_time": at(2), "event_id": "b"}).write.mode("append").parquet(live.inbox)
    sink = ChangelogTable.of(live.job.table, f"{live.root}/out/kpi_tumbling")

    def write_then_die(df, batch_id):
        sink.write_batch(df, batch_id)
        raise RuntimeError("lost")

    stream = clean_stream(stream_parquet(live.session, live.inbox, ORDERS.schema), "5 minutes")
    broken = (live.job.build(Feeds(stream), live.cfg).writeStream.outputMode("update")
              .option("checkpointLocation", f"{live.root}/cp/kpi_tumbling")
              .foreachBatch(write_then_die).trigger(availableNow=True).start())
    with pytest.raises(Exception):
        broken.awaitTermination()
    live.feed(raw_orders({"event_time": at(3), "event_id": "c"}))
    assert [r.order_count for r in live.latest().collect()] == [3]


def test_pipeline(spark, raw_orders, raw_couriers, restaurants, tmp_path):
    """Messages in, archives, dead letters and all metric tables out."""
    orders = raw_orders({"event_time": at(1)}, {"event_time": at(2), "is_duplicate": True},
                        {"event_time": at(1), "event_id": "e0"},
                        {"event_time": at(3), "status": "DELIVERED", "actual_prep_minutes": 30,
                         "actual_delivery_minutes": 70},
                        {"event_time": at(3), "customer_id": "u2", "status": "CANCELLED"})
    fleet = raw_couriers({"event_time": at(1)}, {"event_time": at(4), "status": "OFFLINE"})
    for feed, df, declared in (("orders", orders, ORDERS), ("couriers", fleet, COURIERS)):
        good = df.select(encode_json(df, declared).alias("value"))
        bad = spark.createDataFrame([("{broken",)], "value string")
        good.unionByName(bad).select(F.col("value").cast("binary")).write.parquet(
            f"{tmp_path}/in/{feed}")
    session = streaming_session(spark, 2)
    job = Pipeline(
        session, lambda feed: stream_parquet(session, f"{tmp_path}/in/{feed}", "value binary"),
        restaurants, f"{tmp_path}/out", f"{tmp_path}/cp", wire="json", available_now=True,
        metric_archive=f"{tmp_path}/dated")
    for name, start in job.starters().items():
        query = start()
        assert query.name == name
        query.awaitTermination()

    def latest(name):
        return ChangelogTable.of(JOBS[name].table, f"{tmp_path}/out/metrics/{name}").latest(
            session).collect()

    assert job.archive("orders").read(spark, ORDERS.schema).count() == 4
    assert [r.reason for r in spark.read.parquet(
        f"{job.dead_letters_path('orders')}/data").collect()] == ["malformed"]
    dated = Archive.of_metric(f"{tmp_path}/dated/kpi_tumbling")
    assert dated.read(spark, JOBS["kpi_tumbling"].table.schema).select(
        "order_count", "month").collect() == [(1, 1)]
    assert [r.order_count for r in latest("kpi_tumbling")] == [1]
    assert {r.cancellation_rate for r in latest("kpi_hopping")} == {0.5}
    assert [(r.pending_demand, r.available_supply) for r in latest("demand_supply")] == [(1, 1)]
    assert [(r.restaurant_name, r.sla_breached) for r in latest("restaurant_sla")] == [("One", True)]
    assert {r.anomaly_count for r in latest("delivery_anomalies")} == {1}
    assert [r.fraud_flags for r in latest("fraud_alerts")] == ["ACCOUNT_HOPPING"]
    assert [r.status for r in latest("courier_positions")] == ["OFFLINE"]


def test_a_message_is_parsed_once(spark, raw_orders):
    df = raw_orders({"event_time": at(1)})
    raw = df.select(encode_json(df, ORDERS).cast("binary").alias("value"))
    for rows in (quality.dead_letters(decode_json(raw, ORDERS, keep_raw=True)),
                 quality.clean(decode_json(raw, ORDERS))):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1


def two_feeds(spark, session, tmp_path, name, steps, cfg=MetricConfig()):
    """Feed a metric both feeds step by step; returns its table."""
    job = JOBS[name]
    for i, (orders, fleet) in enumerate(steps):
        for label, df in (("o", orders), ("c", fleet)):
            df.write.mode("append").parquet(f"{tmp_path}/{label}")
        feeds = Feeds(
            clean_stream(stream_parquet(session, f"{tmp_path}/o", ORDERS.schema), cfg.orders_watermark),
            clean_stream(stream_parquet(session, f"{tmp_path}/c", COURIERS.schema), cfg.couriers_watermark))
        start_metric(job, feeds, f"{tmp_path}/out", f"{tmp_path}/cp", cfg,
                     available_now=True).awaitTermination()
    return ChangelogTable.of(job.table, f"{tmp_path}/out/{name}").latest(spark)


def test_dropped_orders_follow_one_rule_in_both_forms(spark, raw_orders, raw_couriers, tmp_path):
    """Two drops, a new courier after the drop, deliveries between and after drops, and steps too
    far from the drop to count."""
    drop = {"status": "OFFLINE", "offline_reason": "MID_DELIVERY_DROP"}
    events = [("IN_TRANSIT", "twice", 5), ("DELIVERED", "twice", 12),      # drops at 10 and 15
              ("IN_TRANSIT", "later", 12),                                 # only after the drop
              ("IN_TRANSIT", "again", 5), ("IN_TRANSIT", "again", 20),     # reassigned, not delivered
              ("IN_TRANSIT", "saved", 5), ("DELIVERED", "saved", 30),
              ("IN_TRANSIT", "too late", 5), ("DELIVERED", "too late", 131),
              ("IN_TRANSIT", "in time", 5), ("DELIVERED", "in time", 130)]
    orders = raw_orders(*[{"order_id": o, "status": s, "event_time": at(t), "event_id": f"{o}{s}{t}"}
                          for s, o, t in events],
                        {"order_id": "end", "event_time": at(300), "event_id": "end",
                         "status": "IN_TRANSIT"})
    fleet = raw_couriers(*[{**drop, "order_id": o, "event_time": at(t), "event_id": f"{o}{t}"}
                           for o, t in (("twice", 10), ("twice", 15), ("later", 10), ("again", 10),
                                        ("saved", 10), ("unknown", 10), ("too late", 10),
                                        ("in time", 10))],
                         {**drop, "order_id": "other", "event_time": at(300), "event_id": "end"})
    batch = couriers.orphaned_deliveries(quality.clean(orders), quality.clean(fleet))
    want = {(r.order_id, r.drop_time, r.in_transit_time) for r in batch.collect()}
    assert {(o, d.minute, t.minute) for o, d, t in want} == {
        ("twice", 15, 5), ("again", 10, 5), ("too late", 10, 5)}
    session = streaming_session(spark, 2)

    def between(low, high):
        return [df.filter((F.col("event_time") >= at(low)) & (F.col("event_time") < at(high)))
                for df in (orders, fleet)]

    judged = two_feeds(spark, session, tmp_path, "judged_drops", [
        between(*b) for b in ((0, 11), (11, 14), (14, 132), (132, 301))])
    rows = judged.collect()
    assert len(rows) == 8
    assert {(r.order_id, r.drop_time.minute) for r in rows if not r.is_orphaned} == {
        ("twice", 10), ("later", 10), ("saved", 10), ("unknown", 10), ("in time", 10)}
    assert {(r.order_id, r.drop_time, r.in_transit_time)
            for r in couriers.last_drops(judged).collect()} == want


def test_dropped_orders_need_no_python_workers(raw_orders, raw_couriers):
    plan = couriers.judged_drops(quality.clean(raw_orders()), quality.clean(raw_couriers()))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


class _Query:
    def __init__(self, name):
        self.name, self.isActive = name, True

    def stop(self):
        self.isActive = False


class _Streams:
    """Stands in for ``spark.streams``: plays a script of outcomes of the wait."""

    def __init__(self, script):
        self.script, self.queries, self.resets = list(script), [], 0

    @property
    def active(self):
        return [q for q in self.queries if q.isActive]

    def awaitAnyTermination(self, timeout):
        assert timeout == 30
        step = self.script.pop(0)
        if isinstance(step, tuple):
            name, step = step
            for q in self.queries:
                if q.name == name:
                    q.isActive = False
        if step == "all done":
            for q in self.queries:
                q.isActive = False
        elif isinstance(step, Exception):
            raise step

    def resetTerminated(self):
        self.resets += 1


def _starters(streams, *names):
    return {n: (lambda n=n: streams.queries.append(_Query(n))) for n in names}


TRANSIENT = RuntimeError('Cannot invoke "scala.Option.get()" because the value is null')


def test_supervisor_restarts_the_dead_query_only():
    streams = _Streams([None, ("a", TRANSIENT), "all done"])
    assert supervise(streams, _starters(streams, "a", "b")) == 1
    assert [q.name for q in streams.queries] == ["a", "b", "a"]


def test_supervisor_raises_other_errors():
    streams = _Streams([("a", ValueError("bad data"))])
    with pytest.raises(ValueError):
        supervise(streams, _starters(streams, "a", "b"))
    assert streams.active == []


def test_supervisor_gives_up_after_the_limit():
    streams = _Streams([("a", TRANSIENT), ("a", TRANSIENT)])
    with pytest.raises(RuntimeError):
        supervise(streams, _starters(streams, "a"), max_restarts=1)


def _drain(spark):
    """Wait until the listeners have heard of everything."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)


def test_a_reader_that_was_down_longer_than_what_is_listed_loses_nothing(
        spark, raw_orders, restaurants, tmp_path):
    """One metric stops, the other goes on for many more batches than are kept, the first returns
    twice; folders between the queries stay few throughout."""
    session = streaming_session(spark, 2)
    inbox = f"{tmp_path}/in"
    spark.createDataFrame([], "value binary").write.parquet(inbox)
    job = Pipeline(session, lambda feed: stream_parquet(session, inbox, "value binary"), restaurants,
                   f"{tmp_path}/out", f"{tmp_path}/cp", wire="json", available_now=True,
                   keep_batches=2, hand_over_files=1, compact_every=4)
    readers = ["kpi_tumbling", "orders_per_minute"]
    cleaned = HandOver(job.cleaned("orders").path, readers, 2, 1)
    object.__setattr__(job, "cleaned", lambda feed: cleaned)
    listener = job.listen()
    listed = []

    def turn(n, *names):
        df = raw_orders({"event_time": at(n), "event_id": f"e{n}"},
                        {"event_time": at(n), "event_id": f"e{max(n - 1, 0)}"})  # a copy of the last
        bad = spark.createDataFrame([(None,)] if n % 2 else [("{",)], "value string")
        df.select(encode_json(df, ORDERS).alias("value")).unionByName(bad).select(
            F.col("value").cast("binary")).write.mode("append").parquet(inbox)
        for start in (lambda: job.land("orders"), lambda: job.clean("orders"),
                      *[lambda name=name: job.metric(name) for name in names]):
            start().awaitTermination()
        _drain(spark)
        listed.append([len(Folder(spark, f"{tmp_path}/out/{stage}/orders").names())
                       for stage in ("landing", "clean")])

    def counts(name):
        return {r.window_start: r.order_count for r in ChangelogTable.of(
            JOBS[name].table, f"{tmp_path}/out/metrics/{name}").latest(session).collect()}

    try:
        for n in range(14):
            down = 3 <= n < 8 or 9 <= n < 12
            turn(n, *(readers[1:] if down else readers))
    finally:
        session.streams.removeListener(listener)
    assert {t.minute: n for t, n in counts("orders_per_minute").items()} == {n: 1 for n in range(14)}
    assert {t.minute: n for t, n in counts("kpi_tumbling").items()} == {
        0: 5, 5: 5, 10: 4}
    # The start folder and two or three batches of the landing; of the clean rows at most what is
    # kept, or what the returning reader had to catch up with.
    assert max(n for n, _ in listed) <= 5
    assert max(n for _, n in listed[3:8] + listed[9:12]) <= 8
    assert listed[-1][1] <= 5
    assert Folder(spark, f"{cleaned.path}-backlog").names() == []


def test_hand_over_numbers_go_on_with_a_new_checkpoint(spark, raw_orders, tmp_path):
    folder = HandOver(str(tmp_path / "landing"), [], keep=3, files=1)
    folder.create(spark, ORDERS.schema)
    for run, batch in (("a", 0), ("a", 1), ("a", 1), ("b", 0), ("b", 1)):
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", run)
        folder.write(raw_orders({"event_id": f"{run}{batch}"}), batch)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    rows = spark.read.parquet(f"{folder.path}/0*").select("event_id", NUMBER).collect()
    assert sorted(map(tuple, rows)) == [("b1", 3)]  # nobody reads, so only the newest stays
    held = HandOver(str(tmp_path / "held"), ["slow"], keep=3, files=1)
    for batch in range(8):
        held.write(raw_orders({"event_id": f"e{batch}"}), batch)
    assert [int(n) for n in Folder(spark, held.path).names()] == [5, 6, 7]
    assert [int(n) for n in Folder(spark, f"{held.path}-backlog").names()] == list(range(5))
    held.restore(spark, "slow")
    assert [int(n) for n in Folder(spark, held.path).names()] == list(range(8))
    held.report(spark, "slow", 6)
    held.write(raw_orders({"event_id": "e8"}), 8)
    assert [int(n) for n in Folder(spark, held.path).names()] == [6, 7, 8]


def test_state_of_utilisation_does_not_grow_with_the_couriers(spark, tmp_path, raw_couriers):
    """Two batches of one window: the same couriers again, one of them busy by now, and a new one."""
    cfg, job = MetricConfig(utilisation_buckets=3), JOBS["courier_utilisation"]
    session, inbox = streaming_session(spark, 2), f"{tmp_path}/in"
    first = [{"courier_id": f"c{i}", "event_time": at(1)} for i in range(300)]
    again = [{"courier_id": f"c{i}", "event_time": at(2)} for i in range(300)]
    again += [{"courier_id": "c7", "status": "HEADING_TO_CUSTOMER", "event_time": at(3)},
              {"courier_id": "new", "event_time": at(3)}, {"courier_id": None, "event_time": at(4)},
              {"courier_id": "c1", "event_time": at(60)}]
    updated = []
    for batch in (first, again):
        raw_couriers(*batch).write.mode("append").parquet(inbox)
        rows = clean_stream(stream_parquet(session, inbox, COURIERS.schema), cfg.couriers_watermark)
        query = start_metric(job, Feeds(couriers=rows), f"{tmp_path}/out", f"{tmp_path}/cp", cfg,
                             available_now=True)
        query.awaitTermination()
        assert query.exception() is None
        updated += [o["numRowsUpdated"] for p in query.recentProgress for o in p["stateOperators"]]
    told = ChangelogTable.of(job.table, f"{tmp_path}/out/{job.name}").latest(spark).collect()
    assert len(told) == 3
    assert {(r.online_couriers, r.busy_couriers) for r in told} == {(302, 1)}
    assert max(updated) <= 6 * 3
