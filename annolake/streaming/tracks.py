"""Trackers, gates, timelines and windows over streams: the batch forms' step functions over keyed state.

Frames need not arrive in order. ``InOrder`` holds the rows of a video back in map state, by time, and gives them to
the tracker frame by frame once the watermark has passed them, so the tracks do not depend on how rows are dealt over
micro-batches. Time to live runs on timers: a track ends without a further frame. Rows behind the watermark come too
late for a frame that is done; Spark drops and counts them (``late_rows``). A second keyed operator, under the same
watermark, holds gate, last pose and summary of each track; ``open_tracks`` reads from its state what has not ended.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator
from datetime import datetime

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from annolake.operators.tracking import TRACKED, BoxTracks, PoseGate, VectorTracks, box_rows, ended_rows, vector_rows

#: What the operators need of a session: their state lies in RocksDB.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}
_FIELDS = [f.split()[0] for f in TRACKED.split(", ")]
FRAME = ("video", "frame_idx", "ts_ms", "det_idx", "x", "y", "width", "height")


def _row(names: list[str], values: list) -> Row:
    return Row(*names)(*values)


class InOrder(StatefulProcessor):
    """Rows of one video, given to ``step`` frame by frame in order of time once the watermark has passed them."""

    def __init__(self, names: list[str], carried: list[str]):
        self.names, self.carried = names, carried

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "ts_ms long", "rows binary")
        self.open()

    def open(self) -> None:
        raise NotImplementedError

    def step(self, video: int, at: int, frames: list[tuple[int, list[dict]]]) -> Iterator[tuple]:
        """Rows of TRACKED for the frames at ``at`` milliseconds, of which there may be none."""
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        by_time = defaultdict(list)
        for r in rows:
            by_time[r["ts_ms"]].append({c: r[c] for c in self.names})
        for ts, new in by_time.items():
            if self.waiting.containsKey((ts,)):
                new = pickle.loads(self.waiting.getValue((ts,))[0]) + new
            else:
                self.handle.registerTimer(ts)
            self.waiting.updateValue((ts,), (pickle.dumps(new),))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at, frames, known = expiredTimerInfo.getExpiryTimeInMs(), defaultdict(list), {}
        if self.waiting.containsKey((at,)):
            for r in pickle.loads(self.waiting.getValue((at,))[0]):
                frames[r["frame_idx"]].append(r)
                known[r["frame_idx"], r["det_idx"]] = r
            self.waiting.removeKey((at,))
        # what is given out now is news of now: an operator that follows takes nothing behind the watermark
        released = datetime.fromtimestamp((max(at, timerValues.getCurrentWatermarkInMs()) + 1) / 1000)
        in_order = [(f, sorted((r for r in rows if r["det_idx"] is not None), key=lambda r: r["det_idx"])) for f, rows in sorted(frames.items())]
        for video, frame, ts, det, track, ended in self.step(key[0], at, in_order):
            own = known.get((frame, det), {}) if det is not None else {}
            yield _row([*_FIELDS, *self.carried, "released"], [video, frame, ts, det, track, ended, *(own.get(c) for c in self.carried), released])

    def close(self) -> None:
        pass


def _box(r: dict) -> tuple:
    return (r["x"], r["y"], r["width"], r["height"])


class BoxStream(InOrder):
    def __init__(self, names: list[str], carried: list[str], options: dict):
        super().__init__(names, carried)
        self.options = options

    def open(self) -> None:
        self.state = self.handle.getValueState("tracks", "next_id long, ids array<long>, boxes array<array<double>>, misses array<long>, hits array<long>")

    def step(self, video: int, at: int, frames: list) -> Iterator[tuple]:
        tracks = BoxTracks(**self.options)
        if self.state.exists():
            tracks.next_id, *columns = self.state.get()
            tracks.tracks = [[i, tuple(b), m, h] for i, b, m, h in zip(*columns, strict=True)]
        for frame, rows in frames:
            yield from box_rows(video, frame, at, [r["det_idx"] for r in rows], [_box(r) for r in rows], tracks)
        columns = [list(c) for c in zip(*tracks.tracks, strict=True)] or [[], [], [], []]
        columns[1] = [[float(x) for x in b] for b in columns[1]]
        self.state.update((tracks.next_id, *columns))


class VectorStream(InOrder):
    def __init__(self, names: list[str], carried: list[str], options: dict):
        super().__init__(names, carried)
        self.options = options

    def open(self) -> None:
        self.tracks = self.handle.getMapState("tracks", "track_id long", "vector array<double>, x double, y double, ts_ms long")
        self.next_id = self.handle.getValueState("next_id", "id long")

    def step(self, video: int, at: int, frames: list) -> Iterator[tuple]:
        state = VectorTracks(**self.options)
        if self.next_id.exists():
            state.next_id = self.next_id.get()[0]
        state.tracks = {k[0]: (np.array(v[0]), (v[1], v[2]), v[3]) for k, v in self.tracks.iterator()}
        before = dict(state.tracks)
        yield from ended_rows(video, state.expired(at))
        for frame, rows in frames:
            found = [(r["embedding"], (r["x"] + r["width"] / 2, r["y"] + r["height"] / 2)) for r in rows]
            yield from vector_rows(video, frame, at, [r["det_idx"] for r in rows], found, state)
        for k in before.keys() - state.tracks.keys():
            self.tracks.removeKey((k,))
        for k, t in state.tracks.items():
            if before.get(k) is not t:
                self.tracks.updateValue((k,), ([float(x) for x in t[0]], float(t[1][0]), float(t[1][1]), t[2]))
                self.handle.registerTimer(state.gone_at(k))
        self.next_id.update((state.next_id,))


def _tracked(frames: DataFrame, delay: str, processor: type, vector: list[str], carried: list[str], options: dict) -> DataFrame:
    names = [*FRAME, *vector, *carried]
    rows = frames.select(F.timestamp_millis("ts_ms").alias("at"), *names).withWatermark("at", delay)
    shape = T.StructType([*(T.StructField(n, T.BooleanType() if n == "ended" else T.LongType()) for n in _FIELDS), *(frames.schema[c] for c in carried)])
    shape = shape.add("released", T.TimestampType())  # the watermark goes on to operators that follow
    return rows.groupBy("video").transformWithState(processor(names, carried, options), shape, "Append", "EventTime", eventTimeColumnName="released")


def track_boxes(frames: DataFrame, *, delay: str = "0 seconds", carried: list[str] | None = None, **options) -> DataFrame:
    """TRACKED rows, and the columns ``carried``, of a stream of frames, those that come up to ``delay`` out of order included."""
    return _tracked(frames, delay, BoxStream, [], carried or [], options)


def track_vectors(frames: DataFrame, *, delay: str = "0 seconds", carried: list[str] | None = None, **options) -> DataFrame:
    """As ``track_boxes``, by appearance; a track ends when the watermark has passed its time to live."""
    return _tracked(frames, delay, VectorStream, ["embedding"], carried or [], options)


SUMMARY = "cls int, n_frames long, n_objects long, first_ms long, last_ms long, n_poses long, last_pose double"
_SUMMARY = [f.split()[0] for f in SUMMARY.split(", ")]
_KEPT = SUMMARY.replace("cls", "first_cls") + ", last_frame long"  # a state's column must not be named cls
HISTORY = f"video long, track_id long, frame_idx long, ts_ms long, due boolean, pose double, ended boolean, {SUMMARY}"
_HISTORY = [f.split()[0] for f in HISTORY.split(", ")]


class Histories(StatefulProcessor):
    """One track: its gate, its last pose (which may be null) and its summary, until it ends."""

    def __init__(self, gate: dict):
        self.gate_options = gate

    def init(self, handle) -> None:
        self.gate = handle.getValueState("gate", "hits long, last_seen long, last_pose long, last_aspect double")
        self.summary = handle.getValueState("summary", _KEPT)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        gate, kept, last_frame = PoseGate(**self.gate_options), None, None
        if self.gate.exists():
            gate.hits, gate.last_seen, gate.last_pose, gate.last_aspect = self.gate.get()
        if self.summary.exists():
            *values, last_frame = self.summary.get()
            kept = dict(zip(_SUMMARY, values, strict=True))
        none = dict.fromkeys(_SUMMARY)
        for r in sorted(rows, key=lambda r: (r["ended"], r["ts_ms"], r["frame_idx"] or 0, r["det_idx"] or 0)):
            at = [key[0], key[1], r["frame_idx"], r["ts_ms"]]
            if r["ended"]:
                yield _row(_HISTORY, [*at, None, None, True, *(kept or none).values()])
                self.gate.clear()
                self.summary.clear()
                return
            if kept is None:
                kept = none | {"cls": r["cls"], "n_frames": 0, "n_objects": 0, "first_ms": r["ts_ms"], "n_poses": 0}
            due = gate.step(r["cls"], r["frame_idx"], r["aspect"])
            kept |= {"n_frames": kept["n_frames"] + (r["frame_idx"] != last_frame), "n_objects": kept["n_objects"] + 1, "last_ms": r["ts_ms"], "n_poses": kept["n_poses"] + due}
            kept |= {"last_pose": r["pose"]} if due else {}
            last_frame = r["frame_idx"]
            yield _row(_HISTORY, [*at, due, kept["last_pose"], False, *none.values()])
        self.gate.update((gate.hits, gate.last_seen, gate.last_pose, float(gate.last_aspect)))
        self.summary.update((*(kept[c] for c in _SUMMARY), last_frame))

    def close(self) -> None:
        pass


def histories(tracked: DataFrame, **gate) -> DataFrame:
    """A row for each sighting of a track (due: whether its pose is run; pose: that of the last run), and one with its summary when it ends.

    ``tracked``: a stream of tracked rows with ``cls``, ``aspect`` and ``pose``, the pose that a run would give.
    """
    rows = tracked.where("track_id <> 0").select("video", "track_id", "frame_idx", "ts_ms", "det_idx", "ended", "cls", "aspect", "pose", "released")
    return rows.groupBy("video", "track_id").transformWithState(Histories(gate), HISTORY, "Append", "None")


def open_tracks(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(video, track_id, summary columns) of the tracks that have not ended, from the state of a query over ``histories``."""
    held = spark.read.format("state-metadata").load(checkpoint).where(F.col("operatorProperties").contains('"stateName":"summary"'))
    operator = held.agg(F.max("operatorId")).first()[0]
    state = spark.read.format("statestore").option("operatorId", operator).option("stateVarName", "summary").load(checkpoint)
    return state.select("key.video", "key.track_id", *[F.col(f"value.{k.split()[0]}").alias(c) for k, c in zip(_KEPT.split(", "), _SUMMARY)])


def late_rows(query) -> int:
    """Rows that came behind the watermark, over the progress that ``query`` remembers."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])


def windowed_counts(events: DataFrame, at: str, late: str, width: str, slide: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """(start, by..., n) for each tumbling or sliding window, events later than ``late`` left out."""
    window = F.window(at, width, slide) if slide else F.window(at, width)
    return events.withWatermark(at, late).groupBy(window.alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *by, "n")


def sessions(events: DataFrame, key: str, at: str, late: str, gap: str) -> DataFrame:
    """(key, start, n) of each run of events with less than ``gap`` between them."""
    out = events.withWatermark(at, late).groupBy(key, F.session_window(at, gap).alias("s")).agg(F.count("*").alias("n"))
    return out.select(key, F.col("s.start").alias("start"), "n")
