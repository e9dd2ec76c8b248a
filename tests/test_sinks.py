import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from tests.test_archive import Crash
from tests.test_archive import _dies as dies
from zonepulse.model import LIVE_TABLES, METRIC_TABLES, RESTAURANT_SLA_BY_RESTAURANT
from zonepulse.sinks import archive, database
from zonepulse.sinks.changelog import ChangelogTable
from zonepulse.sinks.manifest import Folder, Manifest
from zonepulse.sources import files

SCHEMA = "k string, v int"


def _table(spark, tmp_path):
    return ChangelogTable(str(tmp_path / "t"), ["k"], spark.createDataFrame([], SCHEMA).schema)


def _latest(spark, table):
    return dict(map(tuple, table.latest(spark).collect()))


def test_replayed_batch_changes_nothing(spark, tmp_path):
    table = _table(spark, tmp_path)
    table.write_batch(spark.createDataFrame([("a", 1), ("b", 1)], SCHEMA), 0)
    second = spark.createDataFrame([("b", 2)], SCHEMA)
    table.write_batch(second, 1)
    before = _latest(spark, table)
    table.write_batch(second, 1)
    assert _latest(spark, table) == before == {"a": 1, "b": 2}


def test_compaction_and_later_batches(spark, tmp_path):
    table = _table(spark, tmp_path)
    for i in range(3):
        table.write_batch(spark.createDataFrame([("a", i), (f"k{i}", i)], SCHEMA), i)
    before = _latest(spark, table)
    assert table.compact(spark) == (0, 2)
    assert table.compact(spark) == (0, 2)
    assert _latest(spark, table) == before
    table.write_batch(spark.createDataFrame([("a", 9)], SCHEMA), 10)
    assert _latest(spark, table) == {**before, "a": 9}
    assert table.compact(spark) == (0, 10)
    assert _latest(spark, table) == {**before, "a": 9}


def test_a_new_checkpoint_is_newer_than_all_before(spark, tmp_path):
    table = _table(spark, tmp_path)
    for i in range(3):
        table.write_batch(spark.createDataFrame([("a", i), ("b", i)], SCHEMA), i, "first")
    table.compact(spark)
    table.write_batch(spark.createDataFrame([("a", 7)], SCHEMA), 0, "second")
    assert _latest(spark, table) == {"a": 7, "b": 2}
    assert table.compact(spark) == (1, 0)
    table.write_batch(spark.createDataFrame([("b", 8)], SCHEMA), 1, "second")
    assert _latest(spark, table) == {"a": 7, "b": 8}


def test_folders_stay_few(spark, tmp_path):
    table = _table(spark, tmp_path)
    for i in range(9):
        table.write_batch(spark.createDataFrame([("a", i), (f"k{i}", i)], SCHEMA), i)
        if i % 3 == 2:
            table.compact(spark)
    assert table.folders(spark) <= 6
    assert _latest(spark, table) == {"a": 8, **{f"k{i}": i for i in range(9)}}


def test_an_unfinished_batch_is_not_read(spark, tmp_path):
    table = _table(spark, tmp_path)
    table.write_batch(spark.createDataFrame([("a", 1)], SCHEMA), 0)
    spark.createDataFrame([("a", 2)], SCHEMA).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{table.path}/changes/run=0/batch_id=1")
    assert _latest(spark, table) == {"a": 1}


@pytest.mark.parametrize("call", [1, 2])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_batch_or_a_compaction_that_dies(spark, tmp_path, monkeypatch, call, when):
    """The manifest is updated twice by a first batch (run, batch) and once by the others."""
    table = _table(spark, tmp_path)
    first = spark.createDataFrame([("a", 1)], SCHEMA)
    dies(monkeypatch, Manifest, "update", call, when)
    with pytest.raises(Crash):
        table.write_batch(first, 0)
    monkeypatch.undo()
    assert _latest(spark, table) in ({}, {"a": 1})
    table.write_batch(first, 0)
    table.write_batch(spark.createDataFrame([("b", 2)], SCHEMA), 1)
    for n in range(2, 5):
        before = _latest(spark, table)
        dies(monkeypatch, Manifest, "update", 1, when)
        with pytest.raises(Crash):
            table.compact(spark)
        monkeypatch.undo()
        assert _latest(spark, table) == before
        table.write_batch(spark.createDataFrame([("b", n), (f"k{n}", n)], SCHEMA), n)
        assert _latest(spark, table) == {**before, "b": n, f"k{n}": n}
    assert table.compact(spark) == (0, 4)
    assert _latest(spark, table) == {"a": 1, "b": 4, "k2": 2, "k3": 3, "k4": 4}
    assert len(Folder(spark, table.path).names("snapshots")) <= 4
    # A batch that was compacted before its checkpoint was written comes once more.
    table.write_batch(spark.createDataFrame([("b", 4), ("k4", 4)], SCHEMA), 4)
    assert _latest(spark, table) == {"a": 1, "b": 4, "k2": 2, "k3": 3, "k4": 4}


def test_null_value_is_a_value(spark, tmp_path):
    table = _table(spark, tmp_path)
    table.write_batch(spark.createDataFrame([("a", 1)], SCHEMA), 0)
    table.write_batch(spark.createDataFrame([("a", None)], SCHEMA), 1)
    assert _latest(spark, table) == {"a": None}


def test_archive_prunes_hours(spark, orders, tmp_path):
    df = orders(*[{"event_time": at(60 * h + 30), "event_id": f"h{h}"} for h in range(6)])
    path = str(tmp_path / "raw")
    archive.write_raw(df, path)
    archive.write_raw(df.limit(0), path)
    part = files.read_archive(spark, path, "2024-01-01 01:30:00", "2024-01-01 03:30:00")
    assert {r.event_id for r in part.collect()} == {"h1", "h2"}
    scanned = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scanned and "PartitionFilters: []" not in scanned
    assert len(part.select(F.input_file_name()).distinct().collect()) == 2


def test_database_statements():
    table = METRIC_TABLES["demand_supply_health"]
    ddl = database.create_table_sql(table)
    assert "pending_demand BIGINT DEFAULT 0" in ddl
    assert "PRIMARY KEY (window_start, window_end, zone_id)" in ddl
    sql = database.upsert_sql(table, "stage")
    assert "ON CONFLICT (window_start, window_end, zone_id) DO UPDATE SET pending_demand = " in sql
    for t in METRIC_TABLES.values():
        assert database.create_table_sql(t).count("\n") == len(t.columns) + 2


def test_the_statements_run(spark):
    """Every table is made and upserted into, by a database of this process."""
    con = duckdb.connect()
    for table in {**METRIC_TABLES, **LIVE_TABLES}.values():
        con.execute(database.create_table_sql(table))
        con.execute(database.create_table_sql(table))
        con.execute(f"CREATE TABLE stage AS SELECT * FROM {table.name} LIMIT 0")
        cells = {"TIMESTAMP": "TIMESTAMP '2024-01-01'", "STRING": "'{0}'", "BIGINT": "{0}",
                 "INT": "{0}", "DOUBLE": "{0}", "BOOLEAN": "true"}
        for n in (1, 2, 2):
            con.execute("DELETE FROM stage")
            con.execute("INSERT INTO stage SELECT " + ", ".join(
                cells[f.dataType.simpleString().upper()].format(0 if f.name in table.keys else n)
                for f in table.schema.fields))
            con.execute(database.upsert_sql(table, "stage"))
            (row,) = con.execute(f"SELECT * FROM {table.name}").fetchall()
            got = dict(zip(table.columns, row, strict=True))
            assert all(got[f.name] == n for f in table.schema.fields
                       if f.name in table.values and f.dataType.simpleString() in ("bigint", "double", "int"))
        con.execute("DROP TABLE stage")


def test_a_database_whose_key_has_no_zone(spark, monkeypatch):
    table, staged = METRIC_TABLES["restaurant_sla"], []
    rows = [{"window_start": at(0), "window_end": at(15), "restaurant_id": r, "zone_id": z,
             "order_count": n, "sla_breached": False}
            for r, z, n in (("R1", "Z1", 1), ("R1", "Z2", 2), ("R2", "Z1", 3))]
    df = spark.createDataFrame([tuple(r.get(c) for c in table.columns) for r in rows], table.schema)
    monkeypatch.setattr(database, "write_staging",
                        lambda d, t, *a: staged.append((t.keys, d.columns, d.collect())))
    for contracts in ({}, {"restaurant_sla": RESTAURANT_SLA_BY_RESTAURANT}):
        sink = database.Database("jdbc:none", {}, duckdb.connect, contracts=contracts)
        monkeypatch.setattr(database.Database, "_run", lambda self, statements: None)
        sink.sink(table, "restaurant_sla")(df, 0)
    assert [len(r) for _, _, r in staged] == [3, 2]
    keys, columns, got = staged[1]
    assert keys == RESTAURANT_SLA_BY_RESTAURANT.keys and columns == table.columns
    assert sorted((r.restaurant_id, r.zone_id, r.order_count) for r in got) == [
        ("R1", "Z2", 2), ("R2", "Z1", 3)]


def test_upsert_sink_stages_then_merges(monkeypatch, spark):
    log = []

    class Connection:
        def cursor(self):
            return self

        def execute(self, sql):
            log.append(sql.split()[0])

        def commit(self):
            log.append("commit")

        def close(self):
            log.append("close")

    monkeypatch.setattr(database, "write_staging",
                        lambda df, t, url, staging, *a: log.append(f"{staging} {df.count()}"))
    table = METRIC_TABLES["windowed_kpis"]
    sink = database.Database("jdbc:none", {}, Connection)
    sink.create_tables([table])
    assert log == ["CREATE", "commit", "close"]
    log.clear()
    for query in ("kpi_tumbling", "kpi_hopping"):
        sink.sink(table, query)(spark.createDataFrame([], table.schema), 0)
    assert log == ["kpi_tumbling_staging 0", "INSERT", "commit", "close",
                   "kpi_hopping_staging 0", "INSERT", "commit", "close"]
