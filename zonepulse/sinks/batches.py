"""A folder of micro-batches, through which one query hands its rows to others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from zonepulse.sinks.manifest import Folder, Manifest
from zonepulse.sources.files import stream_parquet

# Set by Spark on the thread that runs a query's batches; stays the same as long as its checkpoint.
QUERY_ID = "sql.streaming.queryId"
# Column with the number of the hand-over that a row came with.
NUMBER = "_handed_over"


def run_id(spark: SparkSession, default: str = "batch") -> str:
    """Id of the streaming query whose batch this thread is writing."""
    return spark.sparkContext.getLocalProperty(QUERY_ID) or default


class HandOver:
    """Numbered folders of rows that the queries ``readers`` have yet to read.

    Numbers go up by one from batch to batch and across checkpoints of the writer; a repeated batch
    overwrites its own folder.  Readers report how far they have committed (see ``ProgressListener``)
    and the least of them decides what is deleted: no reader ever loses a row.

    What readers list at every trigger stays short all the same.  A folder older than ``keep``
    batches that only readers in want of it need, none of which has committed anything for ``keep``
    batches, is moved to a backlog beside the folder.  A reader that starts again gets its backlog
    back first: the same files, as old as they were, so that it reads them before newer ones and
    the other readers know them.
    """

    def __init__(self, path: str, readers: Sequence[str], keep: int, files: int = 8):
        self.path, self.readers = path.rstrip("/"), tuple(readers)
        self.keep, self.files = keep, files
        self._numbers = Manifest(f"{self.path}-state/numbers")

    def _progress(self, reader: str) -> Manifest:
        return Manifest(f"{self.path}-state/progress/{reader}")

    @property
    def _backlog(self) -> str:
        return f"{self.path}-backlog"

    @staticmethod
    def _name(number: int) -> str:
        return f"{number:012d}"

    def create(self, spark: SparkSession, schema: T.StructType) -> None:
        """Make the folder, so that a reader may start before the writer."""
        spark.createDataFrame([], schema).coalesce(1).write.mode("ignore").parquet(
            f"{self.path}/start")

    def _newest(self, spark: SparkSession) -> int:
        return self._numbers.read(spark)[1].get("number", -1)

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Hand over a micro-batch, as few files; fit for ``foreachBatch``."""
        spark, batch = df.sparkSession, [run_id(df.sparkSession), batch_id]
        number = self._numbers.update(spark, lambda m: None if m.get("batch") == batch else {
            "batch": batch, "number": m.get("number", -1) + 1})["number"]
        (df.withColumn(NUMBER, F.lit(number).cast("long")).repartition(self.files)
         .write.mode("overwrite").parquet(f"{self.path}/{self._name(number)}"))
        self._tidy(spark, number)

    def _tidy(self, spark: SparkSession, newest: int) -> None:
        """Delete what every reader has committed, and set aside what only stopped readers need."""
        state = [self._progress(r).read(spark)[1] for r in self.readers]
        done = min((s.get("upto", -1) for s in state), default=newest)
        active = [s.get("upto", -1) for s in state if newest - s.get("at", -1) < self.keep]
        folder = Folder(spark, self.path)
        for name in folder.names():
            if not name.isdigit():
                continue
            if int(name) < done:
                folder.delete(name)
            elif int(name) <= newest - self.keep and int(name) < min(active, default=newest):
                folder.move(name, f"{self._backlog}/{name}")
        if newest % self.keep == 0:
            backlog = Folder(spark, self._backlog)
            for name in backlog.names():
                if name.isdigit() and int(name) < done:
                    backlog.delete(name)

    def report(self, spark: SparkSession, reader: str, upto: int) -> None:
        """``reader`` has committed rows of hand-over ``upto``, so all before it are done with."""
        at = self._newest(spark)
        self._progress(reader).update(spark, lambda m: {
            "upto": max(upto, m.get("upto", -1)), "at": max(at, m.get("at", -1))})

    def restore(self, spark: SparkSession, reader: str) -> None:
        """Give a reader that is about to start what was set aside for it, and mark it active."""
        done = self._progress(reader).read(spark)[1].get("upto", -1)
        self.report(spark, reader, done)
        backlog = Folder(spark, self._backlog)
        for name in backlog.names():
            if name.isdigit() and int(name) >= done:
                backlog.move(name, f"{self.path}/{name}")

    def stream(self, spark: SparkSession, schema: T.StructType, label: str,
               max_files: int | None = None) -> DataFrame:
        """The rows as a stream that tells, as observed metric ``label``, how far it has read."""
        numbered = T.StructType([*schema.fields, T.StructField(NUMBER, T.LongType())])
        rows = stream_parquet(spark, f"{self.path}/*", numbered, max_files)
        return rows.observe(label, F.max(NUMBER).alias("upto")).drop(NUMBER)


class ProgressListener(StreamingQueryListener):
    """Reports to each hand-over what its readers have committed.

    ``hand_overs`` has the hand-over by the label of the observed metric.  Spark tells of a batch
    after it is committed, so a crash can only make a report too low.
    """

    def __init__(self, spark: SparkSession, hand_overs: dict[str, HandOver]):
        self._spark, self._hand_overs = spark, hand_overs

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for label, row in (progress.observedMetrics or {}).items():
            known = self._hand_overs.get(label)
            if known and progress.name in known.readers and row["upto"] is not None:
                known.report(self._spark, progress.name, row["upto"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
