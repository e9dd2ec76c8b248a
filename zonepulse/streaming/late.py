"""The rows a windowed metric dropped because its watermark had passed their window.

Spark drops them without a word.  What a micro-batch read, and the watermarks of all batches, stand
in the checkpoint of its query before the batch runs.  A window is let go at the end of a batch by
the watermark which that batch ran with; so a row is dropped if its window had ended by the
watermark of the batch before its own, and the same batch can set aside exactly those rows, whatever
other queries see and when.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonepulse.config import MetricConfig
from zonepulse.functions.windows import tumbling
from zonepulse.operators import quality, sla
from zonepulse.sinks.archive import Archive
from zonepulse.sinks.manifest import Folder


@dataclass(frozen=True)
class Windowed:
    """What of a feed a metric counts, and the length of its tumbling windows."""

    counted: Callable[[DataFrame], DataFrame]
    minutes: Callable[[MetricConfig], int]


def _with_status(*names: str) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: rows.filter(F.col("status").isin(*names))


# Metrics of tumbling windows over one feed.
WINDOWED: dict[str, Windowed] = {
    "kpi_tumbling": Windowed(_with_status("PLACED", "CONFIRMED"), lambda c: c.kpi_minutes),
    "orders_per_minute": Windowed(_with_status("PLACED"), lambda c: 1),
    "revenue_per_hour": Windowed(_with_status("DELIVERED"), lambda c: 60),
    "restaurant_sla": Windowed(sla.delivered_with_prep, lambda c: c.sla_minutes),
}


class LateRows:
    """Sets aside, batch by batch, what the metric ``name`` drops.

    ``checkpoint`` is that of its query, which reads Parquet files of ``schema`` from one folder.
    A batch that is repeated sets aside the same rows once.
    """

    def __init__(self, name: str, checkpoint: str, path: str, schema: T.StructType, cfg: MetricConfig):
        self._windowed, self._cfg, self._schema = WINDOWED[name], cfg, schema
        self._checkpoint = checkpoint
        self.archive = Archive(path)

    def _offsets(self, folder: Folder, batch_id: int) -> tuple[int, int]:
        """The watermark (milliseconds) of a batch and the last entry of the file log it reads."""
        text = folder.read(f"offsets/{batch_id}") if batch_id >= 0 else None
        if text is None:
            return 0, -1
        _, about, source, *_ = text.splitlines()
        return json.loads(about)["batchWatermarkMs"], json.loads(source)["logOffset"]

    def files(self, spark: SparkSession, batch_id: int) -> tuple[int, list[str]]:
        """The watermark that closed windows before a batch, and the files it read."""
        folder = Folder(spark, self._checkpoint)
        upto = self._offsets(folder, batch_id)[1]
        watermark, since = self._offsets(folder, batch_id - 1)
        found = {}
        for entry in range(since + 1, upto + 1):
            text = folder.read(f"sources/0/{entry}") or folder.read(f"sources/0/{entry}.compact") or ""
            for line in text.splitlines()[1:]:
                seen = json.loads(line)
                if since < seen["batchId"] <= upto:
                    found[seen["path"]] = None
        return watermark, list(found)

    def late(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """The rows of a batch that came too late for it; null if there can be none."""
        watermark, files = self.files(spark, batch_id)
        if not files or watermark <= 0:
            return None
        rows = self._windowed.counted(quality.clean(
            spark.read.schema(self._schema).parquet(*files)))
        end: Column = tumbling(self._windowed.minutes(self._cfg))["end"]
        return rows.withColumn("_end", end).filter(
            F.unix_micros("_end") <= watermark * 1000).drop("_end")

    def write(self, spark: SparkSession, batch_id: int) -> None:
        rows = self.late(spark, batch_id)
        if rows is not None:
            rows.persist()
            try:
                self.archive.write_batch(rows, batch_id)
            finally:
                rows.unpersist()

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows set aside, with the hour of their event."""
        schema = quality.clean(spark.createDataFrame([], self._schema)).schema
        return self.archive.read(spark, schema)
