"""The archive with its manifests: repeated batches, compaction, crashes between any two steps."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from zonepulse.model import ORDERS
from zonepulse.session import streaming_session
from zonepulse.sinks import archive, manifest
from zonepulse.sinks.archive import Archive
from zonepulse.sinks.manifest import KEPT_VERSIONS, Folder, Manifest

HOUR = "2024-01-01-00"


class Crash(Exception):
    pass


def ids(stored, spark, **bounds):
    return Counter(r.event_id for r in stored.read(spark, ORDERS.schema, **bounds).collect())


@pytest.fixture
def rows(raw_orders):
    """Events ``name0`` to ``name<n>``, in the first two hours by turns."""
    return lambda name, n=4: raw_orders(*[
        {"event_id": f"{name}{i}", "event_time": at(60 * (i % 2) + 5)} for i in range(n)])


def test_three_compactions_with_late_rows(spark, rows, tmp_path):
    stored, want = Archive(str(tmp_path / "raw")), Counter()
    for turn in range(3):
        for batch in range(2):
            stored.write_batch(rows(f"t{turn}b{batch}-"), 2 * turn + batch, "run")
            want += Counter(f"t{turn}b{batch}-{i}" for i in range(4))
        for key in stored.keys(spark):
            assert stored.compact(spark, key)
        assert ids(stored, spark) == want
    assert stored.keys(spark) == [HOUR, "2024-01-01-01"]
    assert sum(ids(stored, spark, start=HOUR, end=HOUR).values()) == 12
    for key in stored.keys(spark):
        assert not stored.compact(spark, key)
    assert ids(stored, spark) == want
    # What was replaced is gone, and each turn's rows lie in one folder.
    names = Folder(spark, stored._folder(HOUR)).names()
    assert len([n for n in names if n.startswith("batch=")]) == 3


def test_a_reader_that_planned_before_a_compaction_still_reads(spark, rows, tmp_path):
    stored = Archive(str(tmp_path / "raw"))
    for batch in range(2):
        stored.write_batch(rows(f"b{batch}-"), batch, "run")
    planned = stored.read(spark, ORDERS.schema)
    stored.compact(spark, HOUR)
    assert planned.count() == 8


def test_a_repeated_batch_counts_once_even_after_compaction(spark, rows, tmp_path):
    stored = Archive(str(tmp_path / "raw"), compact_at=2)
    for run, batch in (("a", 0), ("a", 0), ("a", 1), ("a", 1), ("b", 0), ("b", 0), ("b", 1), ("b", 1)):
        stored.write_batch(rows(f"{run}{batch}-"), batch, run)
    assert ids(stored, spark) == Counter(f"{r}{b}-{i}" for r in "ab" for b in range(2) for i in range(4))


def test_an_empty_batch_and_an_empty_archive(spark, rows, tmp_path):
    stored = Archive(str(tmp_path / "raw"))
    stored.write_batch(rows("x").limit(0), 0, "run")
    assert stored.keys(spark) == [] and ids(stored, spark) == Counter()


def test_a_batch_is_read_once(spark, rows, tmp_path):
    stored, read = Archive(str(tmp_path / "raw")), spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            read.add(len(frame))
            yield frame

    df = rows("a", 10)
    stored.write_batch(df.mapInPandas(counted, df.schema), 0, "run")
    assert read.value == 10
    assert ids(stored, spark) == Counter(f"a{i}" for i in range(10))


def test_a_streaming_batch_is_written_without_a_sort(spark, rows, tmp_path):
    stored, session = Archive(str(tmp_path / "raw")), streaming_session(spark)
    rows("a").write.parquet(f"{tmp_path}/in")
    rows("b").write.mode("append").parquet(f"{tmp_path}/in")
    archive.archive_stream(session.readStream.schema(ORDERS.schema).parquet(f"{tmp_path}/in"), stored,
                           f"{tmp_path}/cp", "unsorted", available_now=True).awaitTermination()
    assert ids(stored, spark) == Counter(f"{n}{i}" for n in "ab" for i in range(4))
    assert int(session.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 8
    assert not Folder(spark, stored.path).names("incoming")


@pytest.mark.parametrize(("name", "call", "when"), [
    ("move", 1, "before"), ("move", 1, "after"), ("move", 2, "before"), ("move", 2, "after")])
def test_a_batch_that_dies_while_it_is_moved_is_repeated_without_loss(
        spark, rows, tmp_path, monkeypatch, name, call, when):
    stored = Archive(str(tmp_path / "raw"))
    _dies(monkeypatch, Folder, name, call, when)
    with pytest.raises(Crash):
        stored.write_batch(rows("a"), 0, "run")
    monkeypatch.undo()
    assert all(n == 1 for n in ids(stored, spark).values())
    stored.write_batch(rows("a"), 0, "run")
    stored.write_batch(rows("a"), 0, "run")
    assert ids(stored, spark) == Counter(f"a{i}" for i in range(4))
    assert not Folder(spark, stored.path).names("incoming")


# Where a batch or a compaction dies: (what is patched, on which call, before or after it).
CRASHES = [("update", n, when) for n in (1, 2) for when in ("before", "after")]


@pytest.mark.parametrize(("what", "call", "when"), CRASHES)
def test_a_batch_that_dies_is_repeated_without_loss(spark, rows, tmp_path, monkeypatch, what, call, when):
    stored = Archive(str(tmp_path / "raw"))
    stored.write_batch(rows("a"), 0, "run")
    _dies(monkeypatch, Manifest, what, call, when)
    with pytest.raises(Crash):
        stored.write_batch(rows("b"), 1, "run")
    monkeypatch.undo()
    seen = ids(stored, spark)
    assert max(seen.values()) == 1 and {f"a{i}" for i in range(4)} <= set(seen)
    stored.write_batch(rows("b"), 1, "run")
    stored.write_batch(rows("b"), 1, "run")
    assert ids(stored, spark) == Counter(f"{n}{i}" for n in "ab" for i in range(4))


def _dies(monkeypatch, owner, name, call, when):
    real, calls = getattr(owner, name), []

    def run(*args, **kwargs):
        calls.append(1)
        if len(calls) == call and when == "before":
            raise Crash
        result = real(*args, **kwargs)
        if len(calls) == call:
            raise Crash
        return result

    monkeypatch.setattr(owner, name, run)


@pytest.mark.parametrize(("owner", "name", "when"), [
    (Folder, "delete", "after"),      # replaced folders half deleted
    (Manifest, "update", "before"),   # full copy written, not swapped
    (Manifest, "update", "after"),    # swapped, old folders still there
    (Folder, "create", "before"), (Folder, "create", "after"),
])
def test_a_compaction_that_dies_changes_nothing(spark, rows, tmp_path, monkeypatch, owner, name, when):
    stored, want = Archive(str(tmp_path / "raw")), Counter()

    def add(batch):
        nonlocal want
        stored.write_batch(rows(f"b{batch}-"), batch, "run")
        want += Counter(f"b{batch}-{i}" for i in range(4))

    for batch in range(2):
        add(batch)
    assert stored.compact(spark, HOUR)
    for batch in range(2, 4):
        add(batch)
    _dies(monkeypatch, owner, name, 1, when)
    with pytest.raises(Crash):
        stored.compact(spark, HOUR)
    monkeypatch.undo()
    assert ids(stored, spark) == want
    add(4)
    assert ids(stored, spark) == want
    add(5)
    assert stored.compact(spark, HOUR)
    assert ids(stored, spark) == want
    stored.compact(spark, HOUR)
    now = stored._manifest(HOUR).read(spark)[1]
    left = {n.removeprefix("batch=") for n in Folder(spark, stored._folder(HOUR)).names()
            if n.startswith("batch=")}
    assert set(now["live"]) <= left <= {*now["live"], *now["replaced"]}


def test_of_two_writers_one_comes_second(spark, tmp_path):
    shared = Manifest(str(tmp_path / "m"))
    shared.update(spark, lambda m: {"n": [0]})
    entered = []

    def slow(m):
        if not entered:
            entered.append(1)
            shared.update(spark, lambda other: {"n": [*other["n"], "fast"]})
        return {"n": [*m["n"], "slow"]}

    assert shared.update(spark, slow) == {"n": [0, "fast", "slow"]}
    assert shared.read(spark) == (2, {"n": [0, "fast", "slow"]})
    assert shared.update(spark, lambda m: None) == {"n": [0, "fast", "slow"]}
    for i in range(15):
        shared.update(spark, lambda m: {"n": i})
    names = [n for n in Folder(spark, shared.path).names() if n.endswith(".json")]
    assert len(names) == KEPT_VERSIONS
    assert json.loads(Folder(spark, shared.path).read(names[-1])) == {"n": 14}
    assert Folder(spark, shared.path).read("none.json") is None
    assert manifest.newest_versions(spark, str(tmp_path))["m"].endswith(names[-1])


def test_dead_letters_write_nothing_without_any(spark, tmp_path):
    df = spark.createDataFrame([("x", "malformed")], "raw_value string, reason string")
    path = str(tmp_path / "dead")
    archive.write_dead_letters(df.limit(0), path, 0)
    assert not (tmp_path / "dead").exists()
    for _ in range(2):
        archive.write_dead_letters(df, path, 1)
    got = spark.read.parquet(f"{path}/data")
    assert got.count() == 1 and got.filter(F.col("date").isNotNull()).count() == 1
