"""Run a stored feed through a streaming metric in arrival order.

The feed is cut into drops by arrival time.  Drop after drop lands in the input folder and the
query runs on it (``availableNow``) from the same checkpoint, the way a scheduled job would.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from zonepulse.sinks.manifest import Folder
from zonepulse.sources.files import PLAIN_COLUMNS, stream_parquet

DROP_SECONDS = 8 * 3600


class DropZone:
    """Stages a bounded feed once and releases it drop by drop into a stream's input folder.

    Drops are ``drop_seconds`` of arrivals; the first begins ``early_seconds`` before the epoch.
    A drop is a folder that is moved, so a stream sees it whole or not at all.
    """

    def __init__(self, feed: DataFrame, root: str, columns: Sequence[str],
                 drop_seconds: int = DROP_SECONDS, early_seconds: int = 0):
        self.stage, self.inbox = f"{root}/stage", f"{root}/inbox"
        drop = F.floor((F.unix_seconds(F.col("ingestion_time")) + early_seconds) / drop_seconds)
        kept = feed.select(*columns, drop.alias("drop"))
        self.schema = T.StructType([f for f in kept.schema.fields if f.name != "drop"])
        self.spark = feed.sparkSession
        kept.write.options(**PLAIN_COLUMNS).partitionBy("drop").parquet(self.stage)
        # The input folder must exist before the first query starts.
        kept.drop("drop").limit(0).write.parquet(f"{self.inbox}/none")

    def drops(self) -> list[int]:
        """Numbers of the drops still to be released in arrival order, from the partition folders."""
        names = Folder(self.spark, self.stage).names()
        return sorted(int(n.removeprefix("drop=")) for n in names if n.startswith("drop="))

    def release(self, drop: int) -> None:
        Folder(self.spark, self.stage).move(f"drop={drop}", f"{self.inbox}/drop-{drop}")

    def stream(self, spark: SparkSession) -> DataFrame:
        return stream_parquet(spark, f"{self.inbox}/*", self.schema)


def replay(spark: SparkSession, zones: Sequence[DropZone], start: Callable[[], StreamingQuery]) -> None:
    """Release the drops of all feeds in step and run the query after each release."""
    pending = [(z, set(z.drops())) for z in zones]
    for drop in sorted(set().union(*[d for _, d in pending])):
        for zone, present in pending:
            if drop in present:
                zone.release(drop)
        query = start()
        query.awaitTermination()
        if query.exception():
            raise query.exception()


def replay_in_batches(zone: DropZone, start: Callable[[], StreamingQuery]) -> None:
    """Release drop after drop to one query that runs on, so that each micro-batch is a drop."""
    first, *others = zone.drops()
    zone.release(first)
    query = start()
    try:
        query.processAllAvailable()
        for drop in others:
            zone.release(drop)
            query.processAllAvailable()
    finally:
        query.stop()
