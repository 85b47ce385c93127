"""Watermark ordering of a stream: exact and sequential within each physical channel, in parallel across channels.

State of a channel (RocksDB): ticks of its virtual channels, the channel-level tick, the global watermark, the time of
its last advance, and pending events by ranges of tso (SPAN), of which a batch reads and writes only those that its rows
touch. Rows of one message share their offset and differ in row_pos (rows of a multi-row insert, keys of a delete). Each
micro-batch sorts a channel's rows by (offset, row_pos) and applies them one by one: late events go out at once with route
"late", ticks release pending events in order (tso, deletes first, offset, row_pos) with route "change". If the watermark
has not advanced for ``stall_timeout_ms`` while events are pending, everything pending is released in order (route
"forced") and the watermark rises to the highest of them. A channel that holds more than ``max_events`` or ``max_bytes``
is full: it is released likewise, but only if it is stalled as well; until then events wait in the state, on disk, so none
turns late for want of room. With ``heartbeats`` each channel gives a row with route "heartbeat" for each batch it takes
part in: the last offset read and the watermark. Source rate limits (maxFilesPerTrigger, maxOffsetsPerTrigger) keep
micro-batches small.

Spark's own watermarks can't express this: they are one value, the largest event time less a delay, between batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

INPUT = "p long, row_pos long, kind string, pchannel string, vchannel string, tso long, payload string"
OUTPUT = "pchannel string, seq long, route string, p long, row_pos long, kind string, vchannel string, tso long, payload string, watermark long"
NAMES = [c.split()[0] for c in OUTPUT.split(", ")]


@dataclass
class Options:
    stall_timeout_ms: int = 30_000
    max_events: int = 10_000
    max_bytes: int = 64 << 20
    heartbeats: bool = False


#: Bits of a tso below its range: about a second.
SPAN = 28
_EVENT = "p long, row_pos long, kind string, vchannel string, tso long, payload string"


def event_size(payload: str | None) -> int:
    return 256 + 2 * len(payload or "")


class Channel:
    """The rules for one physical channel, on plain values; storage is the processor's business."""

    def __init__(self, ticks: dict[str, int | None], channel_tick: int, watermark: int):
        self.ticks, self.channel_tick, self.watermark = ticks, channel_tick, watermark

    def is_late(self, tso: int) -> bool:
        return self.watermark > 0 and tso <= self.watermark

    def track(self, vchannel: str) -> None:
        """A virtual channel first seen by an event takes over the channel-level tick."""
        if vchannel not in self.ticks:
            self.ticks[vchannel] = self.channel_tick or None

    def tick(self, vchannel: str | None, tso: int) -> bool:
        """Apply a tick; whether the watermark rose."""
        if vchannel is None:
            self.channel_tick = max(self.channel_tick, tso)
            for v, t in self.ticks.items():
                self.ticks[v] = max(t or 0, tso)
        else:
            self.ticks[vchannel] = max(self.ticks.get(vchannel) or 0, tso)
        least = min((t or 0 for t in self.ticks.values()), default=self.channel_tick)
        if least <= self.watermark:
            return False
        self.watermark = least
        return True


def sort_key(tso: int, kind: str, p: int, row_pos: int = 0) -> tuple:
    """(tso, deletes first, offset, row of the message)."""
    return tso, kind != "Delete", p, row_pos


class Pending:
    """Pending events of a channel in a map state of ranges of tso; ranges are read when needed and written at the end."""

    def __init__(self, state):
        self.state, self.held, self.touched = state, {}, set()
        self.spans = {k[0] for k in state.keys()}

    def _of(self, span: int) -> list[tuple]:
        if span not in self.held:
            self.held[span] = [tuple(x) for x in self.state.getValue((span,))[0]] if span in self.spans else []
        return self.held[span]

    def add(self, event: tuple) -> None:
        span = event[4] >> SPAN
        self._of(span).append(event)
        self.spans.add(span)
        self.touched.add(span)

    def release(self, upto: int | None = None) -> list[tuple]:
        """Events up to a tso (all of them if None), in order, taken out. Rows alike stay in order of arrival."""
        due: list[tuple] = []
        for span in [x for x in self.spans if upto is None or x <= upto >> SPAN]:
            mine = self._of(span)
            due += [e for e in mine if upto is None or e[4] <= upto]
            self.held[span] = [e for e in mine if upto is not None and e[4] > upto]
            self.touched.add(span)
        return sorted(due, key=lambda e: sort_key(e[4], e[2], e[0], e[1]))

    def store(self) -> None:
        for span in self.touched:
            if self.held[span]:
                self.state.updateValue((span,), (self.held[span],))
            elif self.state.containsKey((span,)):
                self.state.removeKey((span,))


class Orderer(StatefulProcessor):
    def __init__(self, options: Options):
        self.options = options

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.meta = handle.getValueState("meta", "channel_tick long, watermark long, advanced_at long, seq long, events long, bytes long")
        self.position = handle.getValueState("position", "p long")
        self.ticks = handle.getMapState("ticks", "vchannel string", "tick long")
        self.pending = handle.getMapState("pending", "span long", f"events array<struct<{_EVENT.replace(' ', ':').replace(',:', ',')}>>")

    def _load(self, now: int):
        if self.meta.exists():
            tick, mark, at, seq, events, size = self.meta.get()
        else:
            tick, mark, at, seq, events, size = 0, 0, now, 0, 0, 0
        ticks = {k[0]: v[0] for k, v in self.ticks.iterator()}
        return Channel(ticks, tick, mark), at, seq, events, size

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        channel, at, seq, events, size = self._load(now)
        held = pd.concat(list(rows)).sort_values(["p", "row_pos"], kind="stable")
        pending = Pending(self.pending)
        out: list[tuple] = []

        def emit(route, rows_):
            nonlocal seq, events, size
            for p, row_pos, kind, v, tso, payload in rows_:
                if route != "late":
                    seq += 1
                    events, size = events - 1, size - event_size(payload)
                out.append((key[0], None if route == "late" else seq, route, p, row_pos, kind, v, tso, payload, channel.watermark))

        for r in held.itertuples(index=False):
            v = None if pd.isna(r.vchannel) else r.vchannel
            payload = None if pd.isna(r.payload) else r.payload
            if r.kind == "TimeTick":
                if channel.tick(v, int(r.tso)):
                    at = now
                    emit("change", pending.release(channel.watermark))
                continue
            event = (int(r.p), int(r.row_pos), r.kind, v, int(r.tso), payload)
            if channel.is_late(event[4]):
                emit("late", [event])
                continue
            if v is not None:
                channel.track(v)
            pending.add(event)
            events, size = events + 1, size + event_size(payload)
        full = events > self.options.max_events or size > self.options.max_bytes
        if full and now - at >= self.options.stall_timeout_ms:
            due = pending.release()
            channel.watermark, at = max(channel.watermark, due[-1][4]), now
            emit("forced", due)
        if self.options.heartbeats:
            out.append((key[0], None, "heartbeat", int(held["p"].iloc[-1]), None, None, None, None, None, channel.watermark))
        pending.store()
        for v, t in channel.ticks.items():
            self.ticks.updateValue((v,), (t,))
        self.position.update((int(held["p"].iloc[-1]),))
        self.meta.update((channel.channel_tick, channel.watermark, at, seq, events, size))
        self._wake(events, at)
        yield _frame(out)

    def _wake(self, events: int, at: int) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if events:
            self.handle.registerTimer(at + self.options.stall_timeout_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        channel, _, seq, events, _ = self._load(now)
        if not events:
            return
        pending = Pending(self.pending)
        rows = pending.release()
        pending.store()
        channel.watermark = max(channel.watermark, max(r[4] for r in rows))
        out = [(key[0], seq + i + 1, "forced", *r, channel.watermark) for i, r in enumerate(rows)]
        self.meta.update((channel.channel_tick, channel.watermark, now, seq + len(rows), 0, 0))
        yield _frame(out)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """What is stored of a former run. Rows (pchannel, vchannel, tick): ticks, without a vchannel the channel-level one,
        which those take over that are discovered later; the watermark is the least of the virtual channels' ticks, or
        that one. Rows of streaming.state.stored_state() hold watermark, place and pending events besides."""
        channel, now, seq, place = Channel({}, 0, 0), timerValues.getCurrentProcessingTimeInMs(), 0, None
        pending, events, size = Pending(self.pending), 0, 0
        for r in initialState.itertuples(index=False):
            entry = getattr(r, "entry", "tick")
            if entry == "event":
                payload = None if pd.isna(r.payload) else r.payload
                pending.add((int(r.p), int(r.row_pos), r.kind, None if pd.isna(r.vchannel) else r.vchannel, int(r.tso), payload))
                events, size = events + 1, size + event_size(payload)
            elif entry == "channel":
                channel.channel_tick, channel.watermark, seq = int(r.tick), int(r.watermark), int(r.seq)
                place = None if pd.isna(r.p) else int(r.p)
            elif pd.isna(r.vchannel):
                channel.channel_tick = max(channel.channel_tick, int(r.tick))
            else:
                channel.ticks[r.vchannel] = max(channel.ticks.get(r.vchannel) or 0, 0 if pd.isna(r.tick) else int(r.tick)) or None
        for v, t in channel.ticks.items():
            self.ticks.updateValue((v,), (t,))
        pending.store()
        if place is not None:
            self.position.update((place,))
        least = min((t or 0 for t in channel.ticks.values()), default=channel.channel_tick)
        self.meta.update((channel.channel_tick, max(channel.watermark, least), now, seq, events, size))
        if events:
            self.handle.registerTimer(now + self.options.stall_timeout_ms)

    def close(self) -> None:
        pass


def _frame(rows: list[tuple]) -> pd.DataFrame:
    """Rows of OUTPUT; whole numbers that may be null keep their type."""
    df = pd.DataFrame(rows, columns=NAMES)
    return df.astype({c: "Int64" for c in ("seq", "p", "row_pos", "tso", "watermark")})


def order_stream(df: DataFrame, options: Options | None = None, initial_ticks: DataFrame | None = None) -> DataFrame:
    """A stream (or batch) of INPUT columns as released, late and forced events; see OUTPUT.

    row_pos is the row's place in its message; nulls, and an input without it, count as 0.
    initial_ticks(pchannel, vchannel, tick) preloads the ticks of a former run; with rows of streaming.state.stored_state()
    the new run goes on where the former one stood."""
    initial = initial_ticks.groupBy("pchannel") if initial_ticks is not None else None
    row_pos = F.coalesce(F.col("row_pos").cast("long"), F.lit(0)) if "row_pos" in df.columns else F.lit(0)
    return df.withColumn("row_pos", row_pos.cast("long")).groupBy("pchannel").transformWithStateInPandas(
        statefulProcessor=Orderer(options or Options()), outputStructType=OUTPUT, outputMode="Append", timeMode="ProcessingTime", initialState=initial
    )


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(changes in order, late events) of order_stream."""
    return df.where("route in ('change', 'forced')"), df.where("route = 'late'")


def log_payload(log: DataFrame) -> DataFrame:
    """A log's rows with what is no part of the ordering as one JSON payload."""
    place = [c for c in log.columns if c == "row_pos"]
    rest = [c for c in log.columns if c not in ("p", "row_pos", "kind", "pchannel", "vchannel", "tso")]
    return log.select("p", *place, "kind", "pchannel", "vchannel", "tso", F.to_json(F.struct(*rest)).alias("payload"))


def heartbeats(query) -> list[dict]:
    """A row for each micro-batch of a running query: batch, rows and the time it took."""
    return [{"batch": p["batchId"], "rows": p["numInputRows"], "ms": p["durationMs"].get("triggerExecution", 0)} for p in query.recentProgress]


def drop_repetitions(df: DataFrame, delay: str) -> DataFrame:
    """At-least-once changes (collection, pk, tso, op, at) without repetitions that come within ``delay`` of each other."""
    return df.withWatermark("at", delay).dropDuplicatesWithinWatermark(["collection", "pk", "tso", "op"])
