"""Tracks over frames: assignment of ids, pose gating, timelines and presence.

A video is one state: its frames depend on all earlier ones, so trackers go through each video once, frame after frame.
Frames are shuffled by video and sorted by Spark; a task streams through them in Arrow batches and holds the state of
one video and the rows of one frame, however long a video is. The step functions are shared by the batch and the
streaming forms. Everything that does not depend on order of assignment is relational.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """IoU of each (x, y, width, height) of ``a`` with the one of ``b`` beside it; the four are the first axis."""
    wide = np.maximum(np.minimum(a[0] + a[2], b[0] + b[2]) - np.maximum(a[0], b[0]), 0.0)
    high = np.maximum(np.minimum(a[1] + a[3], b[1] + b[3]) - np.maximum(a[1], b[1]), 0.0)
    shared = wide * high
    union = a[2] * a[3] + b[2] * b[3] - shared
    return np.divide(shared, union, out=np.zeros_like(shared), where=union > 0)


TIERS = (0.97, 0.9, 0.75, 0.5)  # overlaps down to which pairs are looked for, one after the other
HELD = 500_000  # pairs of boxes that are compared at once, and those that are ranked at once


def _near(a: np.ndarray, b: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, IoU) of the pairs with ``least`` or more, in blocks of whole boxes of ``a``; ``b`` is in order of x.

    Boxes of IoU t share t of either's width and height, so they begin no further apart than the part that is not
    shared. Where rounding may count, because a box is tiny for its place or is none, it is compared with all.
    """
    t, n = least - 0.01, b.shape[1]  # room for rounding
    every = ~((a[2:] > 1e-9 * np.abs(a[:2])) & (t > 0)).all(axis=0)
    spare = np.where(every, 0.0, (1 - t) * a[2:])
    low, high = a[:2] - spare / max(t, 0.01), a[:2] + spare
    start = np.where(every, 0, np.searchsorted(b[0], low[0]))
    count = np.where(every, n, np.maximum(np.searchsorted(b[0], high[0], "right") - start, 0))
    total = np.r_[0, np.cumsum(count)]
    for lo, hi in _blocks(total, HELD):
        i = np.repeat(np.arange(lo, hi), count[lo:hi])
        j = np.arange(total[lo], total[hi]) - total[i] + start[i]
        y = b[1][j]
        ok = every[i] | (y >= low[1][i]) & (y <= high[1][i])
        i, j = i[ok], j[ok]
        score = overlaps(a[:, i], b[:, j])
        ok = score >= least
        yield i[ok], j[ok], score[ok]


def _ranked(blocks: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """(i, j, score) by falling score, then i: all of them, or of more than 2 * HELD the first HELD with all that tie with the last of these; whether all."""
    i, j, score, last = np.zeros(0, int), np.zeros(0, int), np.zeros(0), None
    for block in blocks:
        i, j, score = (np.concatenate(c) for c in zip((i, j, score), block, strict=True))
        if len(i) > 2 * HELD:
            k = np.lexsort((i, -score))[HELD - 1]
            last = score[k], i[k]
            ok = (score > last[0]) | (score == last[0]) & (i <= last[1])
            i, j, score = i[ok], j[ok], score[ok]
    if last is not None:
        ok = (score > last[0]) | (score == last[0]) & (i <= last[1])
        i, j, score = i[ok], j[ok], score[ok]
    order = np.lexsort((i, -score))
    return i[order], j[order], score[order], last is None


def one_to_one(boxes: np.ndarray, tracks: np.ndarray, least: float) -> dict[int, int]:
    """{box: track} by falling IoU of ``least`` or more; equal IoU: smaller box, then smaller track. As if all pairs were ranked.

    Tracks with equal boxes wait in one line, the smallest first. Pairs are ranked tier by tier from the closest down, a
    bounded number at a time, and each time among what is still free: what comes before a pair never depends on it.
    Few pairs are ranked at once.
    """
    out: dict[int, int] = {}
    if len(boxes) * len(tracks) * 100 <= HELD:
        scores, taken = overlaps(boxes.T[:, :, None], tracks.T[:, None, :]), set()
        i, j = np.nonzero(scores >= least)
        for k in np.lexsort((j, i, -scores[i, j])).tolist():
            box, track = int(i[k]), int(j[k])
            if box not in out and track not in taken:
                out[box] = track
                taken.add(track)
        return out
    a, order = boxes.T, np.lexsort(tracks.T[::-1])
    b = tracks[order]
    head = np.flatnonzero(np.r_[True, (b[1:] != b[:-1]).any(axis=1)])
    b, head, end, order = b[head].T, head.tolist(), [*head[1:].tolist(), len(b)], order.tolist()
    for tier in (*(t for t in TIERS if t > least), least):
        whole = False
        while not whole:
            left = np.array([i for i in range(a.shape[1]) if i not in out], int)
            lines = np.array([j for j in range(b.shape[1]) if head[j] < end[j]], int)
            i, j, score, whole = _ranked(_near(a[:, left], b[:, lines], tier))
            edges = np.flatnonzero(np.r_[True, (i[1:] != i[:-1]) | (score[1:] != score[:-1]), True]).tolist() if len(i) else []
            i, j = left[i].tolist(), lines[j].tolist()
            for lo, hi in zip(edges, edges[1:], strict=False):
                if i[lo] not in out and (waiting := [k for k in j[lo:hi] if head[k] < end[k]]):
                    k = min(waiting, key=lambda k: order[head[k]])
                    out[i[lo]] = order[head[k]]
                    head[k] += 1
    return out


@dataclass
class BoxTracks:
    """Tracks of one video by overlap. ``tracks`` holds [id, box, misses, hits]; ``next_id`` is never used twice."""

    least: float = 0.3
    max_age: int = 2
    min_hits: int = 1
    next_id: int = 1
    tracks: list[list] = field(default_factory=list)

    def step(self, boxes: list[tuple]) -> tuple[list[int], list[int]]:
        """(an id or 0 for each box, ids that ended) for the next frame; class plays no part."""
        match = {}
        if boxes and self.tracks:
            match = one_to_one(np.array(boxes, float), np.array([t[1] for t in self.tracks], float), self.least)
        ids, ended = [], []
        hit = set(match.values())
        for i, b in enumerate(boxes):
            if i in match:
                t = self.tracks[match[i]]
                t[1], t[2], t[3] = b, 0, t[3] + 1
            else:
                t = [self.next_id, b, 0, 1]
                self.next_id += 1
                self.tracks.append(t)
                hit.add(len(self.tracks) - 1)
            ids.append(t[0] if t[3] >= self.min_hits else 0)
        kept = []
        for j, t in enumerate(self.tracks):
            if j not in hit:
                t[2] += 1
            if t[2] > self.max_age:
                ended += [t[0]] if t[3] >= self.min_hits else []
            else:
                kept.append(t)
        self.tracks = kept
        return ids, ended


@dataclass
class VectorTracks:
    """Tracks of one video by appearance, within reach and within a time to live."""

    least: float = 0.6
    radius: float = 0.3
    ttl_s: float = 600.0
    blend: float = 0.5
    next_id: int = 1
    tracks: dict[int, tuple] = field(default_factory=dict)  # id: (unit vector, (x, y), ts_ms)

    def gone_at(self, track_id: int) -> int:
        """The first millisecond at which a track that is not seen again no longer lives."""
        return int(self.tracks[track_id][2] + self.ttl_s * 1000) + 1

    def expired(self, ts_ms: int) -> list[tuple[int, int]]:
        """(id, when) of the tracks that no longer live at ``ts_ms``, in order; they are forgotten, their ids never come back."""
        out = sorted(((k, at) for k in self.tracks if (at := self.gone_at(k)) <= ts_ms), key=lambda x: (x[1], x[0]))
        for k, _ in out:
            del self.tracks[k]
        return out

    def step(self, ts_ms: int, found: list[tuple]) -> tuple[list[int], list[tuple[int, int]]]:
        """(an id or 0 for each (vector, centre), tracks that ended) for the next frame; a vector that is null or without length has no id."""
        ended = self.expired(ts_ms)
        unit = []
        for v, _ in found:
            v = np.asarray([] if v is None else v, float)
            n = float(np.sqrt(v @ v))
            unit.append(v / n if n > 0 else None)
        known = list(self.tracks)
        match = self.matched(unit, [at for _, at in found], known) if known else {}
        ids = []
        for i, (u, (_, at)) in enumerate(zip(unit, found, strict=True)):
            if u is None:
                ids.append(0)
                continue
            k = known[match[i]] if i in match else self.next_id
            if i in match:
                v = self.blend * u + (1 - self.blend) * np.asarray(self.tracks[k][0])
                n = float(np.sqrt(v @ v))
                u = v / n if n > 0 else v
            else:
                self.next_id += 1
            self.tracks[k] = (u, tuple(at), ts_ms)
            ids.append(k)
        return ids, ended


    def matched(self, unit: list, centres: list, known: list[int]) -> dict[int, int]:
        """{detection: place in ``known``} by falling likeness, as if all pairs were ranked.

        Vectors that are alike to nine decimals come first in that order. They lie within SAME of each other, so also
        along any one direction, and are found by a sorted column. Only what they leave free meets pair by pair, in
        blocks and in single precision with room for its error; likeness itself is summed for the pairs that pass.
        """
        seen = np.array([i for i, u in enumerate(unit) if u is not None], int)
        if not len(seen):
            return {}
        vectors, tracks = np.array([unit[i] for i in seen]), np.array([self.tracks[k][0] for k in known])
        at, places = np.array([centres[i] for i in seen], float), np.array([self.tracks[k][1] for k in known], float)

        def close(i: np.ndarray, j: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            # to nine decimals, so that equal vectors tie whatever the order of summation
            score = np.round(np.einsum("ij,ij->i", vectors[i], tracks[j]), 9)
            ok = (score >= least) & (np.hypot(at[i, 0] - places[j, 0], at[i, 1] - places[j, 1]) <= self.radius)
            return i[ok], j[ok], score[ok]

        axis = np.cos(np.arange(1, vectors.shape[1] + 1) ** 2)  # any fixed direction
        axis /= np.sqrt(axis @ axis)
        along, order = vectors @ axis, np.argsort(tracks @ axis, kind="stable")
        line = (tracks @ axis)[order]
        start, end = np.searchsorted(line, along - SAME), np.searchsorted(line, along + SAME, "right")
        total, n = np.r_[0, np.cumsum(end - start)], len(seen)
        out, taken = {}, np.zeros(len(known), bool)
        if self.least <= 1.0:
            same = [np.zeros(0, int)] * 2
            for lo, hi in _blocks(total):
                i = np.repeat(np.arange(lo, hi), (end - start)[lo:hi])
                j = order[np.arange(total[lo], total[hi]) - total[i] + start[i]]
                i, j, _ = close(i, j, 1.0)
                same = [np.r_[same[0], i], np.r_[same[1], j]]
            for k in np.lexsort((same[1], same[0])).tolist():
                i, j = int(same[0][k]), int(same[1][k])
                if i not in out and not taken[j]:
                    out[i], taken[j] = j, True
        left, free = np.array([i for i in range(n) if i not in out], int), np.flatnonzero(~taken)
        rest = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0))]
        short, other = vectors[left].astype(np.float32), tracks[free].astype(np.float32).T
        for lo, hi in _blocks(np.arange(len(left) + 1) * len(free)):
            i, j = np.divmod(np.flatnonzero(short[lo:hi] @ other >= self.least - 1e-4), max(1, len(free)))
            rest.append(close(left[lo + i], free[j], self.least))
        i, j, score = (np.concatenate(c) for c in zip(*rest, strict=True))
        for k in np.lexsort((j, i, -score)).tolist():
            if int(i[k]) not in out and not taken[j[k]]:
                out[int(i[k])], taken[j[k]] = int(j[k]), True
        return {int(seen[i]): j for i, j in out.items()}


SAME = 1e-4  # unit vectors whose product is 1 to nine decimals differ by less than 3.2e-5
PAIRS = 4_000_000  # pairs of detections and tracks that are compared at once


def _blocks(total: np.ndarray, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold ``most`` pairs (PAIRS) or fewer, or are one row; ``total`` counts the pairs before each row."""
    lo, most = 0, most or PAIRS
    while lo < len(total) - 1:
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


@dataclass
class PoseGate:
    """Whether a pose is due for one track: first sighting, key frame, changed shape, or return after absence."""

    min_hits: int = 2
    key_every: int = 5
    shape_change: float = 0.3
    hits: int = 0
    last_seen: int = -1
    last_pose: int = -1
    last_aspect: float = -1.0

    def step(self, cls: int, frame: int, aspect: float) -> bool:
        if cls != 0:
            return False
        if self.hits + 1 < self.min_hits:
            due = False
        elif self.last_pose < 0:
            due = True
        else:
            due = frame - self.last_pose >= self.key_every or abs(aspect - self.last_aspect) > self.shape_change or frame - self.last_seen > 1
        self.hits, self.last_seen = self.hits + 1, frame
        if due:
            self.last_pose, self.last_aspect = frame, aspect
        return due


TRACKED = "video long, frame_idx long, ts_ms long, det_idx long, track_id long, ended boolean"


def in_frames(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, int, int, pd.DataFrame]]:
    """(video, frame_idx, ts_ms, rows) of each frame of sorted batches; a frame may begin in one batch and end in another."""
    rest = None
    for rows in batches:
        rows = rows if rest is None else pd.concat([rest, rows], ignore_index=True)
        keys = rows[["video", "frame_idx", "ts_ms"]].to_numpy()
        edges = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1] if len(rows) else np.zeros(1, int)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield (*(int(x) for x in keys[a]), rows.iloc[a:b])
        rest = rows.iloc[edges[-1] :]
    if rest is not None and len(rest):
        yield (*(int(x) for x in rest[["video", "frame_idx", "ts_ms"]].iloc[0]), rest)


def _in_order(frames: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[tuple]]) -> DataFrame:
    """TRACKED rows that ``run`` makes of the frames of each partition, whole videos in order.

    The number of partitions is fixed, so that small videos are not put together in one task that takes long.
    """
    parts = int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def batched(batches):
        out = []
        for row in run(batches):
            out.append(row)
            if len(out) == 10_000:
                yield pd.DataFrame(out, columns=_FIELDS).astype(_KINDS)
                out = []
        yield pd.DataFrame(out, columns=_FIELDS).astype(_KINDS)

    return frames.repartition(parts, "video").sortWithinPartitions("video", "ts_ms", "frame_idx", "det_idx").mapInPandas(batched, TRACKED)


_FIELDS = ["video", "frame_idx", "ts_ms", "det_idx", "track_id", "ended"]
_KINDS = {"video": "int64", "frame_idx": "Int64", "ts_ms": "int64", "det_idx": "Int64", "track_id": "int64", "ended": bool}


def boxes_of(rows: pd.DataFrame) -> tuple[list[int], list[tuple]]:
    rows = rows[rows["det_idx"].notna()]
    return rows["det_idx"].astype("int64").tolist(), list(rows[["x", "y", "width", "height"]].itertuples(index=False, name=None))


def box_rows(video: int, frame: int, ts: int, dets: list[int], boxes: list[tuple], state: BoxTracks) -> list[tuple]:
    """Rows of TRACKED for the next frame; a frame without detections ages the tracks."""
    ids, ended = state.step(boxes)
    return [(video, frame, ts, d, i, False) for d, i in zip(dets, ids, strict=True)] + [(video, frame, ts, None, i, True) for i in ended]


def track_boxes(frames: DataFrame, **options) -> DataFrame:
    """TRACKED rows for (video, frame_idx, ts_ms, det_idx, x, y, width, height): one for each detection and each end.

    A frame without detections has one row with a null det_idx.
    """

    def run(batches):
        last, state = None, None
        for video, frame, ts, rows in in_frames(batches):
            if video != last:
                last, state = video, BoxTracks(**options)
            yield from box_rows(video, frame, ts, *boxes_of(rows), state)

    return _in_order(frames.select("video", "frame_idx", "ts_ms", "det_idx", "x", "y", "width", "height"), run)


def vector_rows(video: int, frame: int, ts: int, dets: list[int], found: list[tuple], state: VectorTracks) -> list[tuple]:
    ids, ended = state.step(ts, found)
    return ended_rows(video, ended) + [(video, frame, ts, d, i, False) for d, i in zip(dets, ids, strict=True)]


def ended_rows(video: int, ended: list[tuple[int, int]]) -> list[tuple]:
    """Rows of TRACKED: a track ends at the first millisecond beyond its time to live, which is no frame."""
    return [(video, None, at, None, k, True) for k, at in ended]


def track_vectors(frames: DataFrame, until_ms: int | None = None, **options) -> DataFrame:
    """TRACKED rows by appearance for (video, frame_idx, ts_ms, det_idx, x, y, width, height, embedding).

    Tracks end as far as the frames of their own video show, with ``until_ms`` as far as that time. A row for an end
    has no frame; its ts_ms is when the track's time to live was over.
    """

    def run(batches):
        last, state = None, None
        for video, frame, ts, rows in in_frames(batches):
            if video != last:
                if last is not None and until_ms is not None:
                    yield from ended_rows(last, state.expired(until_ms))
                last, state = video, VectorTracks(**options)
            rows = rows[rows["det_idx"].notna()]
            centres = zip(rows["x"] + rows["width"] / 2, rows["y"] + rows["height"] / 2, strict=True)
            yield from vector_rows(video, frame, ts, rows["det_idx"].astype("int64").tolist(), list(zip(rows["embedding"], centres, strict=True)), state)
        if last is not None and until_ms is not None:
            yield from ended_rows(last, state.expired(until_ms))

    return _in_order(frames.select("video", "frame_idx", "ts_ms", "det_idx", "x", "y", "width", "height", "embedding"), run)


def pose_due(observed: DataFrame, **options) -> DataFrame:
    """(video, track_id, frame_idx, due) for (video, track_id, frame_idx, cls, aspect), one state for each track."""

    def run(batches):
        last, gate = None, None
        for rows in batches:
            due = []
            for video, track, cls, frame, aspect in rows[["video", "track_id", "cls", "frame_idx", "aspect"]].itertuples(index=False, name=None):
                if (video, track) != last:
                    last, gate = (video, track), PoseGate(**options)
                due.append(gate.step(cls, frame, aspect))
            yield rows[["video", "track_id", "frame_idx"]].assign(due=np.array(due, bool))

    rows = observed.select("video", "track_id", "frame_idx", "cls", "aspect").repartition("video", "track_id")
    return rows.sortWithinPartitions("video", "track_id", "frame_idx").mapInPandas(run, "video long, track_id long, frame_idx long, due boolean")


def timeline(tracked: DataFrame, order: str) -> DataFrame:
    """(video, track_id, cls, n_frames, n_objects, first_ms, last_ms): id 0 is no track; cls is the earliest one's."""
    return tracked.where("track_id <> 0").groupBy("video", "track_id").agg(
        F.min_by("cls", F.struct("frame_idx", order)).alias("cls"),
        F.count_distinct("frame_idx").alias("n_frames"),
        F.count("*").alias("n_objects"),
        F.min("ts_ms").alias("first_ms"),
        F.max("ts_ms").alias("last_ms"),
    )


def histories(tracked: DataFrame, **gate) -> DataFrame:
    """(video, track_id, cls, n_frames, n_objects, first_ms, last_ms, n_poses, last_pose, ended) of each track.

    ``tracked``: rows of TRACKED with cls, aspect and pose, the pose that a run would give. A pose is run when the gate
    says that it is due; otherwise the last one holds, null if that run gave none.
    """
    seen = tracked.where("track_id <> 0 and not ended")
    due = pose_due(seen, **gate)
    rows = carried(seen.join(due, ["video", "track_id", "frame_idx"]), ["video", "track_id"], "frame_idx", "due", F.col("pose"), "held")
    poses = rows.groupBy("video", "track_id").agg(F.count_if("due").alias("n_poses"), F.max_by("held", "frame_idx").alias("last_pose"))
    ends = tracked.where("ended").select("video", "track_id", F.lit(True).alias("ended"))
    out = timeline(seen, "det_idx").join(poses, ["video", "track_id"]).join(ends, ["video", "track_id"], "left")
    return out.withColumn("ended", F.coalesce("ended", F.lit(False)))


def per_frame(tracked: DataFrame) -> DataFrame:
    """(video, frame_idx, n_tracks, ids): tracks turned back into frames; ids joined in order."""
    ids = F.array_join(F.array_sort(F.collect_set("track_id")).cast("array<string>"), ",")
    return tracked.where("track_id <> 0").groupBy("video", "frame_idx").agg(F.count_distinct("track_id").alias("n_tracks"), ids.alias("ids"))


def presence_periods(frames: DataFrame, key: str, order: str, at: str, present: str) -> DataFrame:
    """(key, start_ms, end_ms): from a first frame with to the first without; a period still open at the end is left out."""
    own = W.partitionBy(key).orderBy(order)
    flag = F.col(present)
    edge = frames.select(key, order, at, present).withColumn("changed", flag != F.coalesce(F.lag(present).over(own), F.lit(False)))
    ends = edge.where("changed").withColumn("end_ms", F.lead(at).over(own))
    return ends.where(flag & F.col("end_ms").isNotNull()).select(key, F.col(at).alias("start_ms"), "end_ms")


def trail(tracked: DataFrame, order: str, n: int) -> DataFrame:
    """(video, track_id, order, n_trail, x_oldest): the last ``n`` centres of each track, this one included."""
    last = W.partitionBy("video", "track_id").orderBy(order).rowsBetween(1 - n, 0)
    xs = F.collect_list(F.col("x") + F.col("width") / 2).over(last)
    return tracked.select("video", "track_id", order, F.size(xs).alias("n_trail"), xs[0].alias("x_oldest"))


def carried(rows: DataFrame, keys: list[str], order: str, due: str, value: Column, name: str) -> DataFrame:
    """``rows`` with ``name``: the value of the last row that was due, null where that value was null."""
    wrapped = F.when(F.col(due), F.struct(value.alias("v")))
    own = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(wrapped, ignorenulls=True).over(own)["v"])


def active_events(times: DataFrame, events: DataFrame, at: str, bucket: float) -> DataFrame:
    """Pairs of a time and an event with start_s <= time < end_s, met in time buckets rather than in a nested loop."""
    spread = events.withColumn("b", F.explode(F.sequence(F.floor(F.col("start_s") / bucket), F.floor(F.col("end_s") / bucket))))
    keyed = times.withColumn("b", F.floor(F.col(at) / bucket))
    return keyed.join(spread, "b").where((F.col("start_s") <= F.col(at)) & (F.col(at) < F.col("end_s"))).drop("b")


def legacy_step(pairs: DataFrame, objects: DataFrame) -> DataFrame:
    """One step of the older tracker: (image_id, idx, track, life). Each new object takes its best earlier one, whose
    first claimant keeps the id; others get new ids above the image's largest but go on with its life."""
    best = pairs.groupBy("image_id", "ib").agg(F.max_by("ia", F.struct("iou", (-F.col("ia")).alias("o"))).alias("ia"))
    claims = objects.join(best.withColumnRenamed("ib", "idx"), ["image_id", "idx"], "left")
    nth = F.row_number().over(W.partitionBy("image_id", "ia").orderBy("idx"))
    claims = claims.withColumn("owns", F.col("ia").isNotNull() & (nth == 1))
    fresh = F.sum((~F.col("owns")).cast("long")).over(W.partitionBy("image_id").orderBy("idx").rowsBetween(W.unboundedPreceding, 0))
    return claims.select("image_id", "idx", F.when(F.col("owns"), F.col("ia")).otherwise(F.col("old") + fresh - 1).alias("track"), F.when(F.col("ia").isNotNull(), 2).otherwise(1).alias("life"))
