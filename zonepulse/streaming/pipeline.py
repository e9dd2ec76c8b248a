"""The whole live job as named, restartable queries.

Each feed is read and parsed once, by the query that lands it: usable rows go to an hourly archive
and are handed over to the next query, the others go to dead letters.  A second query per feed drops
copies by event id, once for all metrics, and hands the rest on to them; every metric reads its own
columns.  What is handed over stays until its readers have committed it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from zonepulse.config import DEFAULTS, MetricConfig
from zonepulse.model import COURIERS, ORDERS, Feed
from zonepulse.operators import quality
from zonepulse.sinks.archive import Archive, write_dead_letters
from zonepulse.sinks.batches import HandOver, ProgressListener
from zonepulse.sinks.changelog import ChangelogTable
from zonepulse.sinks.database import Database
from zonepulse.sources.decode import decode_avro, decode_json
from zonepulse.streaming.jobs import JOBS, Feeds, MetricJob, clean_stream, start_metric
from zonepulse.streaming.late import WINDOWED, LateRows

_FEEDS: dict[str, Feed] = {"orders": ORDERS, "couriers": COURIERS}
_DECODERS = {"json": decode_json, "avro": decode_avro}


@dataclass(frozen=True)
class Pipeline:
    """Where the job reads and writes.

    ``messages`` opens the raw stream (a binary ``value`` column) of a feed by name.  ``by_key``
    drops copies by event id within the watermark; without it only rows that the producer marked
    are dropped.  ``keep_batches`` bounds what the queries list between them (no reader loses rows
    by it), ``max_files`` what one micro-batch takes, ``hand_over_files`` the files of a hand-over.
    An hour of the archive is compacted whenever it has ``compact_every`` small folders, and a
    metric's changelog every so many batches.
    """

    spark: SparkSession
    messages: Callable[[str], DataFrame]
    restaurants: DataFrame
    root: str
    checkpoints: str
    wire: str = "avro"
    cfg: MetricConfig = DEFAULTS
    available_now: bool = False
    interval: str = "30 seconds"
    by_key: bool = True
    keep_batches: int = 2880
    max_files: int | None = 1000
    hand_over_files: int = 8
    compact_every: int = 100
    database: Database | None = None
    metric_archive: str | None = None

    def archive(self, feed: str) -> Archive:
        """All usable rows of a feed by hour, copies included."""
        return Archive(f"{self.root}/raw/{feed}", compact_at=self.compact_every)

    def dead_letters_path(self, feed: str) -> str:
        return f"{self.root}/dead_letters/{feed}"

    def _hand_over(self, stage: str, feed: str, readers: list[str]) -> HandOver:
        return HandOver(f"{self.root}/{stage}/{feed}", readers, self.keep_batches,
                        self.hand_over_files)

    def landing(self, feed: str) -> HandOver:
        return self._hand_over("landing", feed, [f"clean_{feed}"])

    def cleaned(self, feed: str) -> HandOver:
        return self._hand_over("clean", feed, [
            j.name for j in JOBS.values() if (j.order_columns if feed == "orders" else j.courier_columns)])

    def listen(self) -> ProgressListener:
        """Let the hand-overs know what their readers commit."""
        listener = ProgressListener(self.spark, {
            f"{stage}_{feed}": hand_over(feed) for feed in _FEEDS
            for stage, hand_over in (("landing", self.landing), ("clean", self.cleaned))})
        self.spark.streams.addListener(listener)
        return listener

    def _delay(self, feed: str) -> str:
        return self.cfg.orders_watermark if feed == "orders" else self.cfg.couriers_watermark

    def _start(self, df: DataFrame, name: str, write: Callable[[DataFrame, int], None]
               ) -> StreamingQuery:
        trigger = {"availableNow": True} if self.available_now else {"processingTime": self.interval}
        return (df.writeStream.queryName(name).foreachBatch(write)
                .option("checkpointLocation", f"{self.checkpoints}/{name}").trigger(**trigger).start())

    def decoded(self, feed: str) -> DataFrame:
        """Parsed messages with their text and what is wrong with it."""
        return _DECODERS[self.wire](self.messages(feed), _FEEDS[feed], keep_raw=True)

    def land(self, feed: str) -> StreamingQuery:
        """Parse a feed once and split each micro-batch into usable rows and dead letters."""
        landing, columns = self.landing(feed), _FEEDS[feed].schema.fieldNames()
        landing.create(self.spark, _FEEDS[feed].schema)
        archive = self.archive(feed)

        def write(batch: DataFrame, batch_id: int) -> None:
            batch.persist()
            try:
                usable = quality.dedup_by_flag(quality.validate(batch)).select(*columns)
                archive.write_batch(usable, batch_id)
                write_dead_letters(quality.dead_letters(batch), self.dead_letters_path(feed), batch_id)
                landing.write(usable, batch_id)
            finally:
                batch.unpersist()

        return self._start(self.decoded(feed), f"land_{feed}", write)

    def clean(self, feed: str) -> StreamingQuery:
        """Drop copies of landed rows, once for all metrics."""
        schema, landing, cleaned = _FEEDS[feed].schema, self.landing(feed), self.cleaned(feed)
        cleaned.create(self.spark, schema)
        landing.restore(self.spark, f"clean_{feed}")
        landed = landing.stream(self.spark, schema, f"landing_{feed}", self.max_files)
        rows = clean_stream(landed, self._delay(feed), self.by_key).select(*schema.fieldNames())
        return self._start(rows, f"clean_{feed}", cleaned.write)

    def _cleaned(self, feed: str, reader: str) -> DataFrame:
        cleaned = self.cleaned(feed)
        cleaned.restore(self.spark, reader)
        stream = cleaned.stream(self.spark, _FEEDS[feed].schema, f"clean_{feed}", self.max_files)
        return clean_stream(stream, self._delay(feed))

    def _sink(self, job: MetricJob) -> Callable[[DataFrame, int], None]:
        """The changelog, the rows that came too late for it, and from what it stored the database
        and the dated archive, if any."""
        table = ChangelogTable.of(job.table, f"{self.root}/metrics/{job.name}")
        to_database = self.database.sink(job.table, job.name) if self.database else None
        late = None
        if job.name in WINDOWED:
            late = LateRows(job.name, f"{self.checkpoints}/metrics/{job.name}",
                            f"{self.root}/late/{job.name}", ORDERS.schema, self.cfg)
        dated = None
        if self.metric_archive and "window_start" in job.table.columns:
            dated = Archive.of_metric(f"{self.metric_archive}/{job.name}", self.compact_every)

        def write(batch: DataFrame, batch_id: int) -> None:
            table.write_batch(batch, batch_id)
            if late:
                late.write(batch.sparkSession, batch_id)
            if to_database or dated:
                rows = table.written(batch.sparkSession, batch_id)
                if to_database:
                    to_database(rows, batch_id)
                if dated:
                    dated.write_batch(rows, batch_id)
            if batch_id % self.compact_every == self.compact_every - 1:
                table.compact(batch.sparkSession)

        return write

    def metric(self, name: str) -> StreamingQuery:
        job = JOBS[name]
        feeds = Feeds(self._cleaned("orders", name) if job.order_columns else None,
                      self._cleaned("couriers", name) if job.courier_columns else None,
                      self.restaurants)
        return start_metric(job, feeds, f"{self.root}/metrics", f"{self.checkpoints}/metrics",
                            self.cfg, self.available_now, self.interval, self._sink(job))

    def starters(self) -> dict[str, Callable[[], StreamingQuery]]:
        """Query name to starter, landing first; made for ``supervisor.supervise``."""
        if self.database:
            self.database.create_tables({j.table.name: j.table for j in JOBS.values()}.values())
        self.listen()
        out: dict[str, Callable[[], StreamingQuery]] = {}
        for feed in _FEEDS:
            out[f"land_{feed}"] = lambda feed=feed: self.land(feed)
        for feed in _FEEDS:
            out[f"clean_{feed}"] = lambda feed=feed: self.clean(feed)
        for name in JOBS:
            out[name] = lambda name=name: self.metric(name)
        return out
