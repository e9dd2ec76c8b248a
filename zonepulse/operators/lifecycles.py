"""Metrics that follow one shift, courier or order over a stream, with timers on event time.

Each keeps a small state per key and answers by the watermark: what is told at the end is what the
batch metric of the same name says of all rows that were in time.  Keys are dealt into ``BUCKETS`` by
hash, so that a call works on the columns of many keys at once; the functions below see the rows of
one bucket in one micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from zonepulse.config import DEFAULTS, MetricConfig
from zonepulse.functions.windows import EVENT_TIME, ensure_watermark

_HOUR_MS, _MINUTE_US = 3_600_000, 60_000_000
# What a bucket's state is kept under; like the partitions, for the life of a checkpoint.
BUCKETS = 256


def _bucket(*key: str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int").alias("bucket")


def _micros(column: str) -> Column:
    return F.unix_micros(column)


def _times(values: pd.Series) -> pd.Series:
    return pd.to_datetime(values.astype("Int64"), unit="us")


def _state_frame(state, columns: dict[str, str]) -> pd.DataFrame:
    """The bucket's keys as kept, column by column."""
    kept = state.get if state.exists else [[] for _ in columns]
    return pd.DataFrame({name: pd.array(list(values), dtype=kind)
                         for (name, kind), values in zip(columns.items(), kept, strict=True)})


def _arrived(batches: Iterable[pd.DataFrame], columns: dict[str, str]) -> pd.DataFrame:
    rows = [pdf[list(columns)].astype(columns) for pdf in batches]
    return pd.concat(rows, ignore_index=True) if rows else pd.DataFrame(
        {name: pd.array([], dtype=kind) for name, kind in columns.items()})


def _keep(state, left: pd.DataFrame, due_ms: int | None) -> None:
    """Store a bucket's keys and wake up at ``due_ms``; a timer may not lie at or before the
    watermark.  A bucket without keys is forgotten."""
    if not len(left):
        if state.exists:
            state.remove()
        return
    state.update(tuple([None if v is pd.NA else v for v in left[c].tolist()] for c in left))
    if due_ms is not None:
        state.setTimeoutTimestamp(max(int(due_ms), state.getCurrentWatermarkMs() + 1))


def _state_schema(columns: dict[str, str]) -> str:
    kinds = {"Int64": "long", "Float64": "double", "boolean": "boolean", "string": "string"}
    return ", ".join(f"{name} array<{kinds[kind]}>" for name, kind in columns.items())


# --- shifts ------------------------------------------------------------------------------------

_SHIFT = ("active_session_id string, courier_id string, session_start timestamp, "
          "session_end timestamp, event_count long, session_minutes double, is_closed boolean, "
          "is_over boolean")
_SHIFT_KEY = ["active_session_id", "courier_id"]
_SHIFT_COLUMNS = {"active_session_id": "string", "courier_id": "string", "first": "Int64",
                  "last": "Int64", "declared": "Int64", "offline": "Int64", "n": "Int64"}


def shift_sessions(couriers: DataFrame, cfg: MetricConfig = DEFAULTS) -> DataFrame:
    """A courier's shifts while they last (update mode): a row per shift whenever it changes.

    A shift is closed by OFFLINE.  Its state is kept for ``cfg.shift_linger_hours`` more, in case
    the courier comes back in the same shift; an open shift is given up after
    ``cfg.shift_silence_hours`` without a word.  Then it is told once more, as over.
    """
    at = _micros(EVENT_TIME)
    rows = ensure_watermark(couriers, cfg.couriers_watermark).filter(
        F.col("active_session_id").isNotNull()).select(
        _bucket(*_SHIFT_KEY), *_SHIFT_KEY, EVENT_TIME, at.alias("first"), at.alias("last"),
        _micros("session_start_time").alias("declared"),
        F.when(F.col("status") == "OFFLINE", at).alias("offline"), F.lit(1).cast("long").alias("n"))
    return rows.groupBy("bucket").applyInPandasWithState(
        partial(_follow_shifts, cfg.shift_linger_hours * _HOUR_MS, cfg.shift_silence_hours * _HOUR_MS),
        _SHIFT, _state_schema(_SHIFT_COLUMNS), "update", "EventTimeTimeout")


def _follow_shifts(linger_ms: int, silence_ms: int, key, batches, state) -> Iterator[pd.DataFrame]:
    known = _state_frame(state, _SHIFT_COLUMNS)
    new = _arrived([] if state.hasTimedOut else batches, _SHIFT_COLUMNS)
    both = pd.concat([known.assign(changed=False), new.assign(changed=True)], ignore_index=True)
    shifts = both.groupby(_SHIFT_KEY, sort=False, dropna=False).agg(
        {"first": "min", "last": "max", "declared": "min", "offline": "max", "n": "sum",
         "changed": "max"}).reset_index()
    lingers = (shifts["offline"] == shifts["last"]).fillna(False).astype(bool)
    due = shifts["last"] // 1000 + np.where(lingers, linger_ms, silence_ms)
    # A shift that has just changed waits for the next batch.
    changed = shifts["changed"].astype(bool)
    over = ~changed & (due < state.getCurrentWatermarkMs()).astype(bool)
    left = shifts[~over]
    _keep(state, left[list(_SHIFT_COLUMNS)], due[~over].min() if len(left) else None)
    told = shifts[changed | over]
    if len(told):
        start = told["first"].where(~(told["declared"] < told["first"]).fillna(False), told["declared"])
        yield pd.DataFrame({
            "active_session_id": told["active_session_id"], "courier_id": told["courier_id"],
            "session_start": _times(start), "session_end": _times(told["last"]),
            "event_count": told["n"], "session_minutes": (told["last"] - start) / _MINUTE_US,
            "is_closed": told["offline"].notna(), "is_over": over[told.index]})


# --- suspicious courier rows -------------------------------------------------------------------

_FLAGGED = ("event_id string, courier_id string, zone_id string, event_timestamp timestamp, "
            "speed_kmh double, location_accuracy_meters double, battery_pct int, quality_flags string")
_COURIER_ROW = pa.schema([
    ("courier_id", pa.string()), ("event_id", pa.string()), ("zone_id", pa.string()),
    ("at", pa.int64()), ("speed_kmh", pa.float64()), ("location_accuracy_meters", pa.float64()),
    ("battery_pct", pa.float64()), ("is_offline", pa.bool_())])
_LAST_BATTERY = pa.schema([("courier_id", pa.string()), ("battery_pct", pa.float64())])
# Rows of a bucket that a task holds at a time, and the time that a piece of its state spans where
# there are more.
PIECE_ROWS, SLOT_US = 1 << 16, 10 * _MINUTE_US


def quality_flags(couriers: DataFrame, cfg: MetricConfig = DEFAULTS) -> DataFrame:
    """Suspicious courier rows, each told once when the watermark has passed it (append mode).

    Only then is it certain which row came before it.  A courier's rows wait in the state of its
    bucket till then, in any order of arrival; of the rows told before, the last battery stays.
    """
    rows = ensure_watermark(couriers, cfg.couriers_watermark).select(
        _bucket("courier_id"), "courier_id", "event_id", "zone_id", EVENT_TIME,
        _micros(EVENT_TIME).alias("at"), F.col("speed_kmh").cast("double").alias("speed_kmh"),
        F.col("location_accuracy_meters").cast("double").alias("location_accuracy_meters"),
        F.col("battery_pct").cast("double").alias("battery_pct"),
        (F.col("status") == "OFFLINE").alias("is_offline"))
    return rows.groupBy("bucket").transformWithStateInPandas(
        CourierRows(cfg), _FLAGGED, "append", "EventTime")


class CourierRows(StatefulProcessor):
    """The rows of a bucket's couriers, in pieces of state that are read in the order of time.

    What arrives is stored in pieces of about ``piece_rows`` rows at most; where a call has more,
    each piece holds one slot of time.  Pieces that the watermark has reached are taken up one after
    the other, so that no call and no value of state holds all that arrived in a micro-batch: a task
    holds about ``piece_rows`` rows and those that share a slot with them.
    """

    def __init__(self, cfg: MetricConfig, piece_rows: int = PIECE_ROWS, slot_us: int = SLOT_US):
        self.cfg, self.piece_rows, self.slot_us = cfg, piece_rows, slot_us

    def init(self, handle) -> None:
        self.handle = handle
        # For each piece no row is before ``first``; the timer stands at the least of them.
        self.pieces = handle.getValueState("pieces", "piece array<long>, first array<long>")
        self.waiting = handle.getMapState("waiting", "piece long", "rows binary")
        self.lasts = handle.getValueState("lasts", "rows binary")

    def handleInputRows(self, key, rows, timerValues):
        before = self._pieces()
        pieces, held = dict(before), []
        for pdf in rows:
            held.append(pa.Table.from_pandas(pdf, _COURIER_ROW, preserve_index=False))
            if sum(map(len, held)) >= self.piece_rows:
                self._store(pieces, pa.concat_tables(held))
                held = []
        if held:
            self._store(pieces, pa.concat_tables(held))
        self._keep(pieces, min(before.values(), default=None))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        pieces = self._pieces()
        due = sorted((p for p in pieces if pieces[p] < watermark), key=pieces.get)
        kept = self.lasts.get()
        known = _unpacked(kept[0]) if kept else _LAST_BATTERY.empty_table()
        lasts = dict(zip(known["courier_id"].to_pylist(), known["battery_pct"].to_pylist(), strict=True))
        held = []
        for piece, after in zip(due, [*due[1:], None]):
            end = watermark if after is None else pieces[after]
            held.append(_unpacked(self.waiting.getValue((piece,))[0]))
            self.waiting.removeKey((piece,))
            # All rows before ``end`` are at hand, as the pieces to come begin there.
            if after is None or (sum(map(len, held)) >= self.piece_rows and end > pieces[piece]):
                rows = pa.concat_tables(held)
                passed = pc.less(rows["at"], end)
                ready, held = rows.filter(passed), [rows.filter(pc.invert(passed))]
                if len(ready):
                    yield self._told(ready, lasts)
            del pieces[piece]
        if held and len(held[0]):
            self._store(pieces, held[0])
        if lasts:
            self.lasts.update((_packed(pa.table([list(lasts), list(lasts.values())], _LAST_BATTERY)),))
        # The timer that has run out is deleted after this call.
        self._keep(pieces, None)

    def _pieces(self) -> dict[int, int]:
        kept = self.pieces.get()
        return dict(zip(*kept, strict=True)) if kept else {}

    def _keep(self, pieces: dict[int, int], timer_us: int | None) -> None:
        """Note the pieces, and wake up when the watermark has passed the first of them; the timer
        so far stands at ``timer_us``."""
        if not pieces:
            self.pieces.clear()
            return
        self.pieces.update((list(pieces), list(pieces.values())))
        first = min(pieces.values())
        if first != timer_us:
            if timer_us is not None:
                self.handle.deleteTimer(timer_us // 1000 + 1)
            self.handle.registerTimer(first // 1000 + 1)

    def _store(self, pieces: dict[int, int], rows: pa.Table) -> None:
        """Put rows into state as one piece, or a piece per slot where they are many."""
        at = rows["at"].to_numpy()
        if len(rows) < self.piece_rows:
            parts = [(int(at.min()), rows)]
        else:
            slots = at // self.slot_us
            order = np.argsort(slots, kind="stable")
            rows, slots = rows.take(order), slots[order]
            starts = [0, *(np.flatnonzero(np.diff(slots)) + 1).tolist(), len(rows)]
            parts = [(max(int(slots[a]) * self.slot_us, int(at.min())), rows.slice(a, b - a))
                     for a, b in zip(starts, starts[1:])]
        for first, part in parts:
            piece = max(pieces, default=-1) + 1
            pieces[piece] = first
            self.waiting.updateValue((piece,), (_packed(part),))

    def _told(self, rows: pa.Table, lasts: dict[str | None, float]) -> pd.DataFrame:
        """The suspicious ones among rows that the watermark has passed; ``lasts`` has the battery
        on the last row of each courier, before the call and after it."""
        rows = rows.sort_by([("courier_id", "ascending"), ("at", "ascending"), ("event_id", "ascending")])
        rows = rows.combine_chunks()
        courier = rows["courier_id"].combine_chunks()
        code = courier.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        heads = np.flatnonzero(np.diff(code, prepend=-1))
        ids = courier.take(heads).to_pylist()
        battery = rows["battery_pct"].to_numpy()
        before = np.concatenate([[np.nan], battery[:-1]])[:len(rows)]
        before[heads] = [np.nan if (v := lasts.get(i)) is None else v for i in ids]
        lasts.update(zip(ids, battery[np.append(heads[1:], len(rows)) - 1].tolist(), strict=True))
        names = flag_names(rows, before, self.cfg)
        out = rows.filter(names != "").to_pandas()
        return pd.DataFrame({
            "event_id": out["event_id"], "courier_id": out["courier_id"], "zone_id": out["zone_id"],
            "event_timestamp": _times(out["at"]), "speed_kmh": out["speed_kmh"],
            "location_accuracy_meters": out["location_accuracy_meters"],
            "battery_pct": out["battery_pct"].astype("Int32"), "quality_flags": names[names != ""]})


def _packed(rows: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(rows.combine_chunks())
    return out.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(bytes(data)).read_all()


def flag_names(rows: pa.Table, battery_before: np.ndarray, cfg: MetricConfig) -> np.ndarray:
    """The flags of ``couriers.quality_flags`` for the rows of a table."""
    rules = {
        "IMPOSSIBLE_SPEED": rows["speed_kmh"].to_numpy() >= cfg.impossible_speed_kmh,
        "POOR_ACCURACY": rows["location_accuracy_meters"].to_numpy() > cfg.poor_accuracy_meters,
        "LOW_BATTERY_OFFLINE": rows["is_offline"].fill_null(False).to_numpy()
            & (battery_before <= cfg.low_battery_pct),
    }
    names = np.full(len(rows), "", dtype=object)
    for name, holds in rules.items():
        names[holds] = [f"{old}, {name}" if old else name for old in names[holds]]
    return names


# --- orders ------------------------------------------------------------------------------------

_STEPS = {"PLACED": "placed", "READY_FOR_PICKUP": "ready", "PICKED_UP": "picked_up",
          "DELIVERED": "delivered"}
_DURATIONS = ("order_id string, placed_to_delivered_min double, ready_to_pickup_min double, "
              "pickup_to_delivered_min double")
_ORDER_COLUMNS = {"order_id": "string", **{step: "Int64" for step in _STEPS.values()}, "last": "Int64"}


def order_durations(orders: DataFrame, cfg: MetricConfig = DEFAULTS) -> DataFrame:
    """Minutes between the steps of an order, told once when it is over (append mode).

    An order is over when the watermark has passed its delivery, or when nothing was heard of it
    for ``cfg.order_silence_hours``.  A step that never came gives null.
    """
    at = _micros(EVENT_TIME)
    rows = ensure_watermark(orders, cfg.orders_watermark).filter(
        F.col("status").isin(*_STEPS) & F.col("order_id").isNotNull()).select(
        _bucket("order_id"), "order_id", EVENT_TIME,
        *[F.when(F.col("status") == s, at).alias(name) for s, name in _STEPS.items()],
        at.alias("last"))
    return rows.groupBy("bucket").applyInPandasWithState(
        partial(_follow_orders, cfg.order_silence_hours * _HOUR_MS), _DURATIONS,
        _state_schema(_ORDER_COLUMNS), "append", "EventTimeTimeout")


def _follow_orders(silence_ms: int, key, batches, state) -> Iterator[pd.DataFrame]:
    known = _state_frame(state, _ORDER_COLUMNS)
    new = _arrived([] if state.hasTimedOut else batches, _ORDER_COLUMNS)
    steps = pd.concat([known, new], ignore_index=True).groupby("order_id", sort=False).agg(
        {**{step: "min" for step in _STEPS.values()}, "last": "max"}).reset_index()
    due = steps["delivered"].fillna(steps["last"] + silence_ms * 1000)
    over = (due < state.getCurrentWatermarkMs() * 1000).astype(bool)
    left = steps[~over]
    _keep(state, left[list(_ORDER_COLUMNS)], due[~over].min() // 1000 if len(left) else None)
    told = steps[over]
    if len(told):
        def minutes(a: str, b: str) -> pd.Series:
            return ((told[b] - told[a]) / _MINUTE_US).astype("Float64")

        yield pd.DataFrame({
            "order_id": told["order_id"], "placed_to_delivered_min": minutes("placed", "delivered"),
            "ready_to_pickup_min": minutes("ready", "picked_up"),
            "pickup_to_delivered_min": minutes("picked_up", "delivered")})
