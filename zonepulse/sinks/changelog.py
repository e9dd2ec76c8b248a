"""Keyed upserts on plain Parquet.

Every micro-batch writes the rows it changed into the folder of its run and batch id, and then
enters it in the table's manifest.  A repeated batch that is entered already adds nothing; a query
that starts over from a new checkpoint is a new run, whose batches are newer than all of the runs
before it.  Readers take the newest row per key of what the manifest names; ``compact`` folds the
batches into a snapshot, so that reads stay short.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepulse.model import MetricTable
from zonepulse.sinks import batches
from zonepulse.sinks.manifest import Folder, Manifest

Version = tuple[int, int]


class ChangelogTable:
    """Changelog of one keyed table below ``path``; one query at a time writes to it.

    The manifest names the runs, the last snapshot, the batches since, and what the snapshot
    replaced.  A crash between any two steps leaves folders that nothing names.
    """

    def __init__(self, path: str, keys: Sequence[str], schema: T.StructType):
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.schema = schema
        self._manifest = Manifest(f"{self.path}/manifest")

    @classmethod
    def of(cls, table: MetricTable, path: str) -> ChangelogTable:
        return cls(path, table.keys, table.schema)

    @property
    def _values(self) -> list[str]:
        return [c for c in self.schema.fieldNames() if c not in self.keys]

    def write_batch(self, df: DataFrame, batch_id: int, run_id: str | None = None) -> None:
        """Store the changed rows of a micro-batch; fit for ``foreachBatch``.

        ``run_id`` is by default the id of the streaming query, which lasts as long as its
        checkpoint; batches outside of a query belong to one run of their own.
        """
        spark = df.sparkSession
        version = self._version(spark, batch_id, run_id)
        known = self._state(spark)
        if version in known["batches"] or (known["snapshot"] and version <= known["snapshot"]):
            # The rows are stored, but a stateful query has to run through them all the same.
            df.write.format("noop").mode("overwrite").save()
            return
        (df.select(*self.schema.fieldNames()).write.mode("overwrite")
           .parquet(f"{self.path}/{self._folder(version)}"))
        self._manifest.update(spark, lambda m: {**m, "batches": [*m.get("batches", []), version]})

    def written(self, spark: SparkSession, batch_id: int, run_id: str | None = None) -> DataFrame:
        """The rows of a batch as stored, for sinks beside the changelog."""
        version = self._version(spark, batch_id, run_id)
        return spark.read.schema(self.schema).parquet(f"{self.path}/{self._folder(version)}")

    @staticmethod
    def _folder(version: Version) -> str:
        return f"changes/run={version[0]}/batch_id={version[1]}"

    @staticmethod
    def _snapshot_folder(version: Version) -> str:
        return f"snapshots/run={version[0]}-upto={version[1]}"

    def _state(self, spark: SparkSession) -> dict:
        now = self._manifest.read(spark)[1]
        return {"batches": sorted(tuple(v) for v in now.get("batches", [])),
                "snapshot": tuple(now["snapshot"]) if now.get("snapshot") else None,
                "replaced": now.get("replaced", [])}

    def _version(self, spark: SparkSession, batch_id: int, run_id: str | None) -> Version:
        """The run's number and the batch; a new run gets the next number before it writes."""
        name = run_id or batches.run_id(spark)
        runs = self._manifest.update(spark, lambda m: None if name in m.get("runs", {}) else {
            **m, "runs": {**m.get("runs", {}), name: len(m.get("runs", {}))}})["runs"]
        return runs[name], batch_id

    def _versions(self, spark: SparkSession, state: dict) -> DataFrame:
        """Rows of the snapshot and of the batches since, with ``run`` and ``batch_id``."""
        fields = [*self.schema.fields, T.StructField("run", T.LongType()),
                  T.StructField("batch_id", T.LongType())]
        rows, since = spark.createDataFrame([], T.StructType(fields)), state["snapshot"]
        if state["batches"]:
            rows = (spark.read.schema(T.StructType(fields))
                    .option("basePath", f"{self.path}/changes")
                    .parquet(*[f"{self.path}/{self._folder(v)}" for v in state["batches"]]))
        if not since:
            return rows
        snapshot = spark.read.schema(self.schema).parquet(f"{self.path}/{self._snapshot_folder(since)}")
        return snapshot.withColumns({"run": F.lit(since[0]).cast("long"),
                                     "batch_id": F.lit(since[1]).cast("long")}).unionByName(rows)

    def _newest(self, versions: DataFrame) -> DataFrame:
        newest = F.max_by(F.struct(*self._values), F.struct("run", "batch_id")).alias("row")
        return (versions.groupBy(*self.keys).agg(newest)
                .select(*self.keys, "row.*").select(*self.schema.fieldNames()))

    def latest(self, spark: SparkSession) -> DataFrame:
        """Newest row per key."""
        return self._newest(self._versions(spark, self._state(spark)))

    def folders(self, spark: SparkSession) -> int:
        """Batch folders on disk."""
        return len(Folder(spark, self.path).matching("changes/run=*/batch_id=*"))

    def compact(self, spark: SparkSession) -> Version | None:
        """Write the latest rows as a snapshot and publish it; returns the last version it covers.

        May run beside the writer: only the batches entered so far take part.  What the snapshot
        replaces is deleted by the next compaction, so a reader that has just planned is not
        disturbed; what a compaction that died has left is deleted too.
        """
        state, folder = self._state(spark), Folder(spark, self.path)
        if not state["batches"]:
            return state["snapshot"]
        kept = {self._snapshot_folder(state["snapshot"])} if state["snapshot"] else set()
        lost = {f"snapshots/{n}" for n in folder.names("snapshots")} - kept
        for name in {*state["replaced"], *lost}:
            folder.delete(name)
        upto = state["batches"][-1]
        (self._newest(self._versions(spark, state)).write.mode("overwrite")
         .parquet(f"{self.path}/{self._snapshot_folder(upto)}"))
        replaced = sorted(kept) + [self._folder(v) for v in state["batches"]]
        self._manifest.update(spark, lambda m: {
            **m, "snapshot": upto, "replaced": replaced,
            "batches": [v for v in m["batches"] if tuple(v) > upto]})
        return upto
