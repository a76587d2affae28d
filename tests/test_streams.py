"""Trackers over batches and streams: plain specifications, equal results however rows are dealt over micro-batches."""

from __future__ import annotations

import math
import os
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from annolake.operators import tracking
from annolake.plans import fixtures
from annolake.streaming import tracks

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
HOUR = 3_600_000
LATE = 6 * HOUR
OPTIONS = {"ttl_s": 40 * 3600.0, "least": 0.3}


@pytest.fixture(scope="module")
def frames(spark, tmp_path_factory):
    """Detections of the events with vectors for most of them, stored so that all tests see the same rows."""
    v = fixtures.vectors(spark, DATA).select(F.col("vec_id").alias("track"), F.col("v").alias("embedding"))
    rows = fixtures.detections(spark, DATA).join(v, "track", "left")
    rows = rows.withColumn("aspect", 0.3 + F.col("ts_ms") / HOUR % 8 / 16).withColumn("pose", F.when(F.col("event_id") % 2 == 0, F.col("conf")))
    path = str(tmp_path_factory.mktemp("frames"))
    rows.select(*tracks.FRAME, "embedding", "cls", "aspect", "pose").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture()
def state_store(spark):
    before = {k: spark.conf.get(k, None) for k in tracks.STATE_CONF}
    for k, v in tracks.STATE_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def arrivals(rows):
    """Three parts of ``rows`` by a time of arrival that is up to LATE after the frame: each part is out of order."""
    low, high = rows.agg(F.min("ts_ms"), F.max("ts_ms")).first()
    at = F.col("ts_ms") + F.pmod(F.hash("video", "frame_idx", "det_idx"), F.lit(LATE))
    edges = [low, low + (high - low) // 3, low + 2 * (high - low) // 3, high + 2 * LATE]
    return [rows.where((at >= a) & (at < b)) for a, b in zip(edges, edges[1:], strict=False)], high


def streamed(spark, rows, parts, build, folder):
    """What ``build`` makes of the parts as they arrive; the query is started anew from its checkpoint for each."""
    late = 0
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        query = build(stream).writeStream.format("parquet").option("checkpointLocation", f"{folder}/ck").option("path", f"{folder}/out").trigger(availableNow=True).start()
        query.awaitTermination()
        late += tracks.late_rows(query)
    return spark.read.parquet(f"{folder}/out"), late


def same(a, b, columns):
    return sorted(map(repr, a.select(*columns).collect())) == sorted(map(repr, b.select(*columns).collect()))


TRACKED = ["video", "frame_idx", "ts_ms", "det_idx", "track_id", "ended"]


def test_boxes_out_of_order_give_the_batch_tracks(spark, frames, tmp_path, state_store):
    parts, high = arrivals(frames)
    found, late = streamed(spark, frames, parts, lambda s: tracks.track_boxes(s, delay="6 hours", min_hits=2), str(tmp_path))
    assert late == 0 and same(found, tracking.track_boxes(frames.where(F.col("ts_ms") <= high - LATE), min_hits=2), TRACKED)


def test_vectors_out_of_order_give_the_batch_tracks_and_ends(spark, frames, tmp_path, state_store):
    frames = frames.where(F.col("video") != 3).union(frames.where("video = 3").orderBy("ts_ms").limit(20))  # one video stops early
    parts, high = arrivals(frames)
    found, late = streamed(spark, frames, parts, lambda s: tracks.track_vectors(s, delay="6 hours", **OPTIONS), str(tmp_path))
    expected = tracking.track_vectors(frames.where(F.col("ts_ms") <= high - LATE), until_ms=high - LATE, **OPTIONS)
    assert late == 0 and same(found, expected, TRACKED)
    ended = {(r.video, r.track_id) for r in found.where("ended").collect()}
    shown = {(r.video, r.track_id) for r in tracking.track_vectors(frames.where(F.col("ts_ms") <= high - LATE), **OPTIONS).where("ended").collect()}
    assert shown and shown < ended  # the clock ends tracks that no further frame of their video does


def test_one_chain_from_frames_to_histories(spark, frames, tmp_path, state_store):
    parts, high = arrivals(frames)
    build = lambda s: tracks.histories(tracks.track_vectors(s, delay="6 hours", carried=["cls", "aspect", "pose"], **OPTIONS), key_every=3)
    found, late = streamed(spark, frames, parts, build, str(tmp_path))
    whole = frames.where(F.col("ts_ms") <= high - LATE)
    tracked = tracking.track_vectors(whole, until_ms=high - LATE, **OPTIONS).join(whole.select("video", "frame_idx", "det_idx", "cls", "aspect", "pose"), ["video", "frame_idx", "det_idx"], "left")
    columns = ["video", "track_id", "cls", "n_frames", "n_objects", "first_ms", "last_ms", "n_poses", "last_pose", "ended"]
    still = tracks.open_tracks(spark, f"{tmp_path}/ck").withColumn("ended", F.lit(False))
    assert late == 0 and still.count() and found.where("ended").count()
    assert same(found.where("ended").select(*columns).union(still.select(*columns)), tracking.histories(tracked, key_every=3), columns)
    seen = tracked.where("track_id <> 0 and not ended")
    poses = tracking.carried(seen.join(tracking.pose_due(seen, key_every=3), ["video", "track_id", "frame_idx"]), ["video", "track_id"], "frame_idx", "due", F.col("pose"), "held")
    poses = poses.select("video", "track_id", "frame_idx", "due", F.col("held").alias("pose"))
    assert same(found.where("not ended"), poses, poses.columns)


def test_rows_that_come_too_late_are_counted(spark, frames, tmp_path, state_store):
    low, high = frames.agg(F.min("ts_ms"), F.max("ts_ms")).first()
    old = frames.where(F.col("ts_ms") < low + 24 * HOUR)
    parts = [frames.where(F.col("ts_ms") >= low + 24 * HOUR), old]
    found, late = streamed(spark, frames, parts, lambda s: tracks.track_boxes(s), str(tmp_path))
    assert late == old.count() > 0
    assert same(found, tracking.track_boxes(parts[0].where(F.col("ts_ms") <= high)), TRACKED)


def iou(a, b):
    w, h = (min(a[k] + a[k + 2], b[k] + b[k + 2]) - max(a[k], b[k]) for k in (0, 1))
    both = max(w, 0) * max(h, 0)
    union = a[2] * a[3] + b[2] * b[3] - both
    return both / union if union > 0 else 0.0


def picked(scored):
    out = {}
    for _, i, j in sorted(scored):
        if i not in out and j not in out.values():
            out[i] = j
    return out


def by_frame(rows):
    videos = defaultdict(lambda: defaultdict(list))
    for r in rows:
        videos[r.video][r.frame_idx, r.ts_ms].append(r)
    return {v: sorted((k, sorted((r for r in rows if r.det_idx is not None), key=lambda r: r.det_idx)) for k, rows in frames.items()) for v, frames in videos.items()}


def test_boxes_by_a_plain_specification(frames):
    want = []
    for video, ordered in by_frame(frames.collect()).items():
        live, last_id = [], 0
        for (frame, ts), rows in ordered:
            boxes = [(r.x, r.y, r.width, r.height) for r in rows]
            match = picked([(-s, i, j) for i, b in enumerate(boxes) for j, t in enumerate(live) if (s := iou(b, t["box"])) >= 0.3])
            for j, t in enumerate(live):
                t["miss"] = 0 if j in match.values() else t["miss"] + 1
            for i, b in enumerate(boxes):
                if i in match:
                    t = live[match[i]]
                    t["hits"] += 1
                else:
                    last_id += 1
                    t = {"id": last_id, "miss": 0, "hits": 1}
                    live.append(t)
                t["box"] = b
                want.append((video, frame, ts, rows[i].det_idx, t["id"] if t["hits"] >= 2 else 0, False))
            want += [(video, frame, ts, None, t["id"], True) for t in live if t["miss"] > 1 and t["hits"] >= 2]
            live = [t for t in live if t["miss"] <= 1]
    got = [tuple(r) for r in tracking.track_boxes(frames, max_age=1, min_hits=2).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and any(r[5] for r in want)


def test_vectors_by_a_plain_specification(frames):
    want, dot = [], lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    for video, ordered in by_frame(frames.collect()).items():
        live, last_id = {}, 0
        for (frame, ts), rows in ordered:
            for k in [k for k, t in live.items() if ts - t[2] > OPTIONS["ttl_s"] * 1000]:
                want.append((video, None, live.pop(k)[2] + int(OPTIONS["ttl_s"] * 1000) + 1, None, k, True))
            unit = [None if r.embedding is None else [x / math.sqrt(dot(r.embedding, r.embedding)) for x in r.embedding] for r in rows]
            places = [(r.x + r.width / 2, r.y + r.height / 2) for r in rows]
            scored = [(-s, i, k) for i, u in enumerate(unit) if u for k, t in live.items() if math.dist(places[i], t[1]) <= 0.3 and (s := round(dot(u, t[0]), 9)) >= OPTIONS["least"]]
            match = picked(scored)
            for i, u in enumerate(unit):
                k = 0
                if u and i in match:
                    k = match[i]
                    u = [0.5 * a + 0.5 * b for a, b in zip(u, live[k][0], strict=True)]
                    u = [x / math.sqrt(dot(u, u)) for x in u]
                elif u:
                    last_id += 1
                    k = last_id
                if u:
                    live[k] = (u, places[i], ts)
                want.append((video, frame, ts, rows[i].det_idx, k, False))
    got = [tuple(r) for r in tracking.track_vectors(frames, **OPTIONS).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and any(r[5] for r in want)


def test_frames_may_cross_batches_and_videos_may_be_empty(spark, frames):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = sorted(map(repr, tracking.track_vectors(frames, until_ms=2_000_000_000_000, **OPTIONS).collect()))
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
        assert sorted(map(repr, tracking.track_vectors(frames, until_ms=2_000_000_000_000, **OPTIONS).collect())) == expected
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert tracking.track_vectors(frames.where("video < 0")).collect() == tracking.track_boxes(frames.where("video < 0")).collect() == []


def test_windows_and_sessions_over_a_stream(spark, tmp_path, state_store):
    e = spark.read.parquet(f"{DATA}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    e.coalesce(1).write.parquet(f"{tmp_path}/in")
    end = e.agg(F.max("ts")).first()[0]
    for k, (build, whole) in enumerate((
        (lambda s: tracks.windowed_counts(s, "ts", "1 hour", "1 hour", by=("event_type",)), lambda d: d.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "n")),
        (lambda s: tracks.windowed_counts(s, "ts", "1 hour", "2 hours", "1 hour"), lambda d: d.groupBy(F.window("ts", "2 hours", "1 hour").alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")),
        (lambda s: tracks.sessions(s, "user_id", "ts", "1 hour", "30 minutes"), lambda d: d.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")),
    )):
        query = build(spark.readStream.schema(e.schema).parquet(f"{tmp_path}/in")).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/ck{k}").option("path", f"{tmp_path}/out{k}").trigger(availableNow=True).start()
        query.awaitTermination()
        found = spark.read.parquet(f"{tmp_path}/out{k}")
        closed = whole(e).where(F.col("end") <= F.lit(end) - F.expr("interval 1 hour"))
        assert found.count() and same(found, closed, found.columns)


def test_matching_in_tiers_is_that_of_all_pairs_in_bounded_blocks(monkeypatch):
    import numpy as np

    monkeypatch.setattr(tracking, "PAIRS", 50)
    rng = np.random.default_rng(3)
    v = rng.normal(size=(40, 8))
    state, seen = tracking.VectorTracks(least=0.2, radius=0.5), {}
    for frame in range(12):
        found = [(None if w == 7 else v[w] * (1 + w), (float(w % 5) / 8, float(w % 3) / 8)) for w in rng.integers(0, 40, 30).tolist()]
        unit = [None if x is None else x / math.sqrt(x @ x) for x, _ in found]
        pairs = []
        for i, u in enumerate(unit):
            for j, (t, at, _) in enumerate(state.tracks.values()):
                if u is not None and round(float(u @ t), 9) >= 0.2 and math.dist(at, found[i][1]) <= 0.5:
                    pairs.append((-round(float(u @ t), 9), i, j))
        known, expected = list(state.tracks), {}
        for _, i, j in sorted(pairs):
            if i not in expected and j not in expected.values():
                expected[i] = j
        before = state.next_id
        ids, _ = state.step(frame * 1000, found)
        assert {i: k for i, k in enumerate(ids) if 0 < k < before} == {i: known[j] for i, j in expected.items()}
    assert list(tracking._blocks(np.array([0, 20, 40, 60, 160]))) == [(0, 2), (2, 3), (3, 4)]


def test_boxes_in_tiers_are_matched_as_if_all_pairs_were_ranked(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(5)
    kinds = (
        lambda n: np.c_[rng.integers(0, 60, (n, 2)) / 1024, np.full(n, 96 / 1024), np.full(n, 192 / 1024)],  # many ties
        lambda n: np.c_[rng.integers(0, 3, (n, 2)), np.full(n, 2), rng.integers(0, 3, n)].astype(float),  # many equal boxes, some without area
        lambda n: np.c_[rng.random((n, 2)), rng.random((n, 2)) * 0.5],
        lambda n: np.c_[1e16 + 2 * rng.integers(0, 5, (n, 2)), rng.choice([1.0, 1.5, 2.0, 3.0], (n, 2))],  # rounding makes overlaps above 1
    )
    for draw in kinds:
        for held in (1, 20, 500, tracking.HELD):
            for least in (0.3, 0.9, 1.0, 0.0):
                boxes, tracks = draw(30), draw(40)
                monkeypatch.setattr(tracking, "HELD", held)
                expected = picked([(-s, i, j) for i, b in enumerate(boxes.tolist()) for j, t in enumerate(tracks.tolist()) if (s := iou(b, t)) >= least])
                assert tracking.one_to_one(boxes, tracks, least) == expected
                monkeypatch.undo()


@pytest.mark.parametrize("spread", [40, 1])
def test_a_frame_of_boxes_is_matched_in_bounded_memory(spread):
    import tracemalloc

    import numpy as np

    rng = np.random.default_rng(6)
    boxes = [((u * 97 % 800 + u % 8) / 1024, (u * 61 % 600 + u % 5) / 1024, 96 / 1024, 192 / 1024) for u in (rng.integers(0, 240, 5000) // spread * 10).tolist()]
    state = tracking.BoxTracks()
    assert state.step(boxes[:3000]) == (list(range(1, 3001)), [])
    tracemalloc.start()
    ids, _ = state.step(boxes[3000:])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(set(ids)) == len(ids) == 2000 and peak < 100e6  # a number for each of the 6,000,000 pairs takes 48 MB, the steps over them 300
