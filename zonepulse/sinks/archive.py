"""Partitioned Parquet archives of raw events and of metric tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepulse.sinks.batches import run_id
from zonepulse.sinks.manifest import Folder, Manifest, newest_versions
from zonepulse.sources.files import PLAIN_COLUMNS

RAW_PARTITIONS = ("year", "month", "day", "hour")
METRIC_PARTITIONS = ("year", "month", "day")


def _parts(ts: Column, names: tuple[str, ...]) -> dict[str, Column]:
    functions = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour}
    return {n: functions[n](ts) for n in names}


def with_raw_partitions(df: DataFrame) -> DataFrame:
    """Add year, month, day and hour of the event time."""
    return df.withColumns(_parts(F.col("event_time").cast("timestamp"), RAW_PARTITIONS))


def with_metric_partitions(df: DataFrame) -> DataFrame:
    return df.withColumns(_parts(F.col("window_start"), METRIC_PARTITIONS))


def _write(df: DataFrame, path: str, partitions: tuple[str, ...], mode: str) -> None:
    # The rebalance hint lets AQE merge thin partitions into full files and split an hour that
    # holds far more rows than the others.
    (df.hint("rebalance", *partitions).write.mode(mode).partitionBy(*partitions).parquet(path))


# Innermost folder of what a stream writes: the batch, or the compacted rows of several batches.
BATCH = "batch"
_FULL = "full-"


class Archive:
    """A partitioned archive that a stream adds to and that is compacted beside it.

    Below ``path``, ``data`` holds the rows in folders per partition and batch, ``manifest`` one
    manifest per partition that names the folders that count (``live``).  Readers plan from the
    manifests, so what is half written, left by a crash or already replaced is never read:

    - A batch writes its folders aside (``incoming``), then moves and enters them, partition by
      partition.  Its repetition leaves out the partitions that have it, also where it has been
      compacted since, and puts the others in anew.
    - Compaction writes the rows of the small folders into one new folder and then swaps the names
      in one step.  A crash before that leaves a folder that no one names; the next compaction
      removes it.  Folders that were replaced stay until then, for readers that planned from them.

    One compaction of a partition at a time; batches may be added meanwhile.
    """

    def __init__(self, path: str, partitions: tuple[str, ...] = RAW_PARTITIONS,
                 compact_at: int | None = None):
        self.path = path.rstrip("/")
        self.partitions, self.compact_at = partitions, compact_at

    @classmethod
    def of_metric(cls, path: str, compact_at: int | None = None) -> Archive:
        return cls(path, METRIC_PARTITIONS, compact_at)

    @property
    def _data(self) -> str:
        return f"{self.path}/data"

    def _with_partitions(self, df: DataFrame) -> DataFrame:
        return with_raw_partitions(df) if self.partitions == RAW_PARTITIONS else with_metric_partitions(df)

    def _manifest(self, key: str) -> Manifest:
        return Manifest(f"{self.path}/manifest/{key}")

    def _folder(self, key: str) -> str:
        """``2024-01-31-05`` lies in ``year=2024/month=1/day=31/hour=5``."""
        parts = zip(self.partitions, key.split("-"), strict=True)
        return "/".join([self._data, *[f"{name}={int(value)}" for name, value in parts]])

    def _keys_in(self, folder: Folder) -> dict[str, str]:
        """The folders of the partitions that lie in ``folder``, by key."""
        found = folder.matching("/".join(f"{p}=*" for p in self.partitions))
        names = [p.split("/")[-len(self.partitions):] for p in found]
        values = [[int(n.split("=")[1]) for n in parts] for parts in names]
        return {f"{v[0]:04d}" + "".join(f"-{n:02d}" for n in v[1:]): "/".join(parts)
                for v, parts in zip(values, names, strict=True)}

    def write_batch(self, df: DataFrame, batch_id: int, run: str | None = None) -> None:
        """Add a micro-batch, exactly once however often it is repeated.

        ``df`` is read once: its rows are written aside, and the folder of each partition that does
        not have the batch yet is moved into place.  The driver gets the partitions it touches.
        """
        spark = df.sparkSession
        run = run or run_id(spark)
        label, aside = f"{run}.{batch_id}", Folder(spark, f"{self.path}/incoming/{run}")
        (self._with_partitions(df).hint("rebalance", *self.partitions)
         .write.mode("overwrite").option("partitionOverwriteMode", "static").options(**PLAIN_COLUMNS)
         .partitionBy(*self.partitions).parquet(aside.path))
        for key, folder in sorted(self._keys_in(aside).items()):
            if self._manifest(key).read(spark)[1].get("runs", {}).get(run, -1) >= batch_id:
                continue
            there, name = Folder(spark, self._folder(key)), f"{BATCH}={label}"
            there.delete(name)  # of a try that died before the batch was entered
            if not aside.move(folder, f"{there.path}/{name}"):
                raise RuntimeError(f"{aside.path}/{folder} could not be moved to {there.path}/{name}")
            now = self._manifest(key).update(spark, lambda m, key=key: {
                **m, "key": key, "live": [*m.get("live", []), label],
                "runs": {**m.get("runs", {}), run: batch_id}})
            if self.compact_at and len(self._small(now)) >= self.compact_at:
                self.compact(spark, key)
        aside.delete("")

    @staticmethod
    def _small(manifest: dict) -> list[str]:
        return [b for b in manifest.get("live", []) if not b.startswith(_FULL)]

    def compact(self, spark: SparkSession, key: str) -> bool:
        """Make one folder of the small ones of a partition; false if there are fewer than two."""
        version, now = self._manifest(key).read(spark)
        small, here = self._small(now), Folder(spark, self._folder(key))
        named = {*now.get("live", []), *now.get("replaced", [])}
        lost = [n.removeprefix(f"{BATCH}=") for n in here.names() if n.startswith(f"{BATCH}={_FULL}")]
        for gone in [*now.get("replaced", []), *[n for n in lost if n not in named]]:
            here.delete(f"{BATCH}={gone}")
        if len(small) < 2:
            return False
        full = f"{_FULL}{version}"
        rows = spark.read.option("mergeSchema", "true").parquet(
            *[f"{here.path}/{BATCH}={b}" for b in small])
        (rows.hint("rebalance").write.mode("overwrite").options(**PLAIN_COLUMNS)
         .parquet(f"{here.path}/{BATCH}={full}"))
        self._manifest(key).update(spark, lambda m: {
            **m, "live": [full, *[b for b in m["live"] if b not in small]], "replaced": small})
        return True

    def keys(self, spark: SparkSession) -> list[str]:
        """The partitions there are, in order."""
        return sorted(newest_versions(spark, f"{self.path}/manifest"))

    def read(self, spark: SparkSession, schema: T.StructType, start: str | None = None,
             end: str | None = None) -> DataFrame:
        """What counts in the partitions from ``start`` to ``end`` (keys, inclusive), with the
        partition columns.  The manifests are read by a job, however many there are."""
        fields = [f for f in schema.fields if f.name not in self.partitions]
        whole = T.StructType([*fields, *[T.StructField(p, T.IntegerType()) for p in self.partitions]])
        newest = newest_versions(spark, f"{self.path}/manifest")
        chosen = [p for k, p in newest.items() if (not start or k >= start) and (not end or k <= end)]
        folders = []
        if chosen:
            live = spark.read.schema("key string, live array<string>").json(chosen)
            folders = [f"{self._folder(r['key'])}/{BATCH}={b}" for r in live.collect() for b in r["live"]]
        if not folders:
            return spark.createDataFrame([], whole)
        return (spark.read.schema(whole).option("basePath", self._data).parquet(*folders)
                .select(*whole.fieldNames()))


def write_raw(df: DataFrame, path: str, mode: str = "append") -> None:
    _write(with_raw_partitions(df), path, RAW_PARTITIONS, mode)


def write_metric(df: DataFrame, path: str, mode: str = "append") -> None:
    _write(with_metric_partitions(df), path, METRIC_PARTITIONS, mode)


def write_dead_letters(df: DataFrame, path: str, batch_id: int) -> None:
    """Add a micro-batch's rejected messages under the day they were rejected on, exactly once.

    A batch without any writes nothing.  A batch that is repeated on the next day goes by the day
    that its row of the manifest names, so that it replaces its own.
    """
    if df.isEmpty():
        return
    spark = df.sparkSession
    label = f"{run_id(spark)}.{batch_id}"
    today = spark.range(1).select(F.current_date().cast("string")).first()[0]
    begun = Manifest(f"{path}/batch").update(
        spark, lambda m: None if m.get("batch") == label else {"batch": label, "date": today})
    (df.withColumn("rejected_at", F.current_timestamp()).write.mode("overwrite")
     .parquet(f"{path}/data/date={begun['date']}/{BATCH}={label}"))


def archive_stream(df: DataFrame, archive: Archive, checkpoint: str, name: str,
                   available_now: bool = False, interval: str = "1 minute"):
    """Append every event of a stream to an archive, exactly once."""
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (df.writeStream.queryName(name).foreachBatch(archive.write_batch)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())
