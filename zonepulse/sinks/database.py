"""Metric tables in a relational database: DDL, staging writes and upsert statements."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepulse.model import MetricTable

_SQL_TYPES = {
    T.TimestampType: "TIMESTAMPTZ", T.StringType: "TEXT", T.LongType: "BIGINT",
    T.IntegerType: "INTEGER", T.DoubleType: "DOUBLE PRECISION", T.BooleanType: "BOOLEAN",
}


def create_table_sql(table: MetricTable) -> str:
    """``CREATE TABLE IF NOT EXISTS`` for a metric table with its key and defaults."""
    lines = []
    for f in table.schema.fields:
        default = table.defaults.get(f.name)
        suffix = "" if default is None else f" DEFAULT {str(default).upper()}"
        lines.append(f"{f.name} {_SQL_TYPES[type(f.dataType)]}{suffix}")
    lines.append(f"PRIMARY KEY ({', '.join(table.keys)})")
    return f"CREATE TABLE IF NOT EXISTS {table.name} (\n  " + ",\n  ".join(lines) + "\n)"


def upsert_sql(table: MetricTable, staging: str) -> str:
    """Move one staged batch into the table, replacing rows by key (safe to repeat)."""
    columns = ", ".join(table.columns)
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in table.values)
    return (f"INSERT INTO {table.name} ({columns}) SELECT {columns} FROM {staging} "
            f"ON CONFLICT ({', '.join(table.keys)}) DO UPDATE SET {updates}")


def write_staging(df: DataFrame, table: MetricTable, url: str, staging: str,
                  properties: dict[str, str], connections: int = 8) -> None:
    """Write changed rows from the executors into a staging table, columns bound by name.

    ``connections`` bounds the number of concurrent database sessions.  The rows are repartitioned
    to it; coalescing would narrow the stateful stage that produces them.
    """
    (df.select(*table.columns).repartition(connections).write
       .option("truncate", "true").mode("overwrite").jdbc(url, staging, properties=properties))


@dataclass(frozen=True)
class Database:
    """A relational database as sink of the metrics.

    ``connect`` opens a DB-API connection on the driver; rows go from the executors over JDBC.
    ``contracts`` are tables that exist there with another key than ours, by name; rows that such a
    key does not tell apart become one before they are staged.
    """

    url: str
    properties: dict[str, str]
    connect: Callable[[], object]
    connections: int = 8
    contracts: Mapping[str, MetricTable] = field(default_factory=dict)

    def create_tables(self, tables: Iterable[MetricTable]) -> None:
        """Make what is missing; once, at start-up."""
        self._run([create_table_sql(self.contracts.get(t.name, t)) for t in tables])

    def _run(self, statements: list[str]) -> None:
        connection = self.connect()
        try:
            cursor = connection.cursor()
            for statement in statements:
                cursor.execute(statement)
            connection.commit()
        finally:
            connection.close()

    def sink(self, table: MetricTable, query: str) -> Callable[[DataFrame, int], None]:
        return upsert_sink(self.contracts.get(table.name, table), self, f"{query}_staging",
                           [k for k in table.keys if k not in self.contracts.get(table.name, table).keys])


def one_per_key(df: DataFrame, table: MetricTable, more: Sequence[str]) -> DataFrame:
    """The row with the greatest ``more`` (the rest of a longer key) for each key of ``table``."""
    if not more:
        return df
    last = F.max_by(F.struct(*table.values), F.struct(*more)).alias("last")
    return df.groupBy(*table.keys).agg(last).select(*table.keys, "last.*").select(*table.columns)


def upsert_sink(table: MetricTable, database: Database, staging: str,
                more: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer: stage the batch from the executors, then upsert it on the server.

    Only the upsert statement runs on the driver's connection.  ``staging`` belongs to one query:
    two queries may write to one table at the same time.  Repeating a batch leaves the table as it
    is.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        write_staging(one_per_key(df, table, more), table, database.url, staging, database.properties, database.connections)
        database._run([upsert_sql(table, staging)])

    return write
