"""Feeds staged for streams and files: spread over tasks, released whole, compressed."""

from pathlib import Path

import pytest
from pyarrow.parquet import ParquetFile

from zonepulse.plans import catalog, testdata
from zonepulse.plans.replay import DropZone
from zonepulse.session import streaming_session

SF_DIR = "/root/testdata/sf0.001"


def test_json_files_are_small_and_many(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "new_work_dir", lambda *_: f"{tmp_path}/json")
    rows = catalog.QUERIES["scan_json_files"](spark, SF_DIR).count()
    files = list(Path(f"{tmp_path}/json").glob("part-*"))
    assert len(files) > 1 and rows > 500
    assert sum(f.stat().st_size for f in files) < 200 * rows


def test_a_drop_is_written_once_by_many_tasks_and_moved_whole(spark, tmp_path):
    feed = testdata.orders_feed(spark, SF_DIR, spread=True)
    zone = DropZone(feed, f"{tmp_path}", ["event_id", "ingestion_time"])
    drops = zone.drops()
    staged = sorted(p.name for p in Path(zone.stage).glob(f"drop={drops[0]}/*.parquet"))
    zone.release(drops[0])
    assert zone.drops() == drops[1:]
    assert len(staged) > 1
    assert sorted(p.name for p in Path(zone.inbox).glob(f"drop-{drops[0]}/*.parquet")) == staged
    for drop in drops[1:]:
        zone.release(drop)
    query = zone.stream(streaming_session(spark)).writeStream.format("memory").queryName(
        "released").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == feed.count()


@pytest.mark.parametrize("name", ["stream_orphaned_deliveries", "stream_demand_supply"])
def test_a_drop_does_not_start_from_every_write_of_the_drops_before(spark, tmp_path, monkeypatch, name):
    monkeypatch.setattr(catalog, "new_work_dir", lambda *_: f"{tmp_path}/run")
    catalog.QUERIES[name](spark, SF_DIR).collect()
    state = [p.suffix for p in Path(f"{tmp_path}/run/checkpoints").glob("*/state/*/*/**/*.*")]
    assert ".zip" in state and ".changelog" not in state


def test_staged_ids_and_times_have_no_dictionary(spark, tmp_path):
    feed = testdata.orders_feed(spark, SF_DIR, spread=True)
    zone = DropZone(feed, f"{tmp_path}", ["event_id", "event_time", "status", "ingestion_time"])
    group = ParquetFile(next(Path(zone.stage).glob("drop=*/*.parquet"))).metadata.row_group(0)
    encodings = {group.column(i).path_in_schema: group.column(i).encodings
                 for i in range(group.num_columns)}
    plain = {c for c, found in encodings.items() if not any("DICTIONARY" in e for e in found)}
    assert {"event_id", "event_time", "ingestion_time"} <= plain and "status" not in plain


def test_short_drops_look_their_state_up_on_the_heap(spark, tmp_path, monkeypatch):
    drops = DropZone.drops
    monkeypatch.setattr(catalog, "new_work_dir", lambda *_: f"{tmp_path}/run")
    monkeypatch.setattr(DropZone, "drops", lambda zone: drops(zone)[:4])
    catalog.QUERIES["stream_fraud_short_drops"](spark, SF_DIR).collect()
    state = {p.suffix for p in Path(f"{tmp_path}/run/checkpoints").glob("*/state/*/*/**/*.*")}
    assert ".delta" in state and not state & {".zip", ".changelog"}
