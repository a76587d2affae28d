"""Queries over frames and tracks."""

from __future__ import annotations

from pyspark.sql import functions as F

from annolake.operators import matching, tracking
from annolake.plans.fixtures import BOXES, DETECTIONS, boxes, detections, pairs_sql, table, vectors
from annolake.plans.query import Query
from annolake.plans.storage import kept


def tracked(spark, d):
    return detections(spark, d).withColumnRenamed("track", "track_id")


def timeline(spark, d):
    return tracking.timeline(tracked(spark, d), "event_id")


def timeline_unpivot(spark, d):
    return tracking.per_frame(tracked(spark, d))


def presence_periods(spark, d):
    flags = detections(spark, d).groupBy("video", "frame_idx", "ts_ms").agg(F.max(F.col("cls") == 1).alias("present"))
    return tracking.presence_periods(flags, "video", "frame_idx", "ts_ms", "present")


def trail_buffer(spark, d):
    return tracking.trail(tracked(spark, d), "event_id", 5)


def pose_carry_forward(spark, d):
    rows = tracked(spark, d).withColumn("due", F.col("event_id") % 3 == 0)
    value = F.when(F.col("event_id") % 2 == 0, F.col("conf"))
    return tracking.carried(rows, ["video", "track_id"], "event_id", "due", value, "pose").select("video", "track_id", "event_id", "pose")


def event_overlay(spark, d):
    times = table(spark, d, "events").select("event_id", (F.unix_millis(F.col("ts").cast("timestamp")) % 86400000 / 1000).alias("t"))
    spans = table(spark, d, "nation").selectExpr("n_name as name", "n_nationkey * 3000D as start_s", "n_nationkey * 3000D + 1800D + n_regionkey * 900D as end_s")
    return tracking.active_events(times, spans, "t", 3600.0).select("event_id", "name")


def legacy_track_step(spark, d):
    b = boxes(spark, d)
    olds = b.where("src = 0").groupBy("image_id").agg((F.max("idx") + 1).alias("old"))
    new = b.where("src = 1").select("image_id", "idx").join(olds, "image_id", "left").na.fill(0)
    return tracking.legacy_step(matching.iou_pairs(b, 0, 1, 0.3), new)


def iou_track(spark, d):
    return tracking.track_boxes(detections(spark, d))


def reid_track(spark, d):
    v = vectors(spark, d).select(F.col("vec_id").alias("video_key"), F.col("v").alias("embedding"))
    rows = detections(spark, d).withColumn("video_key", F.col("track"))
    return tracking.track_vectors(rows.join(v, "video_key"))


def pose_gate(spark, d):
    seen = tracked(spark, d).groupBy("video", "track_id", "frame_idx").agg(F.min_by("cls", "event_id").alias("cls"), (0.3 + F.min("event_id") % 8 / 16).alias("aspect"))
    return tracking.pose_due(seen)


def track_histories(spark, d):
    """The whole chain: frames with vectors to tracks by appearance, gated poses and a summary of each track."""
    v = vectors(spark, d).select(F.col("vec_id").alias("track"), F.col("v").alias("embedding"))
    rows = detections(spark, d).join(v, "track", "left")
    rows = rows.withColumn("aspect", 0.3 + F.col("ts_ms") / 3600000 % 8 / 16).withColumn("pose", F.when(F.col("event_id") % 2 == 0, F.col("conf")))
    until = rows.agg(F.max("ts_ms")).first()[0]
    tracked = kept(tracking.track_vectors(rows, until_ms=until, ttl_s=36 * 3600.0, least=0.3))  # read by each branch of histories
    seen = tracked.join(rows.select("video", "frame_idx", "det_idx", "cls", "aspect", "pose"), ["video", "frame_idx", "det_idx"], "left")
    return tracking.histories(seen, key_every=3)


def track_summary(spark, d):
    return tracked(spark, d).groupBy("video").agg(F.count_distinct("track_id").alias("n_tracks"), F.count("*").alias("n_objects"), (F.max("ts_ms") - F.min("ts_ms")).alias("duration_ms"))


def window_tumbling(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = e.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"))
    return out.select(F.unix_millis("window.start").alias("start_ms"), "event_type", "n")


def window_sliding(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = e.groupBy(F.window("ts", "2 hours", "1 hour")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))
    return out.select(F.unix_millis("window.start").alias("start_ms"), "n", "users")


def session_gap(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = e.groupBy("user_id", F.session_window("ts", "30 minutes")).agg(F.count("*").alias("n"))
    return out.select("user_id", F.unix_millis("session_window.start").alias("start_ms"), "n")


QUERIES = {
    "timeline": Query(
        timeline,
        f"""with {DETECTIONS} select video, track track_id, arg_min(cls, event_id) cls, count(distinct frame_idx) n_frames, count(*) n_objects,
  min(ts_ms) first_ms, max(ts_ms) last_ms from detections where track <> 0 group by all""",
    ),
    "timeline_unpivot": Query(
        timeline_unpivot,
        f"""with {DETECTIONS} select video, frame_idx, count(*) n_tracks, string_agg(track::varchar, ',' order by track) ids
from (select distinct video, frame_idx, track from detections where track <> 0) group by all""",
    ),
    "presence_periods": Query(
        presence_periods,
        f"""with {DETECTIONS}, f as (select video, frame_idx, ts_ms, bool_or(cls = 1) p from detections group by all),
c as (select *, coalesce(lag(p) over (partition by video order by frame_idx), false) was from f),
e as (select *, lead(ts_ms) over (partition by video order by frame_idx) end_ms from c where p <> was)
select video, ts_ms start_ms, end_ms from e where p and end_ms is not null""",
    ),
    "trail_buffer": Query(
        trail_buffer,
        f"""with {DETECTIONS} select video, track track_id, event_id, (count(*) over w)::int n_trail, first_value(x + width / 2) over w x_oldest
from detections window w as (partition by video, track order by event_id rows 4 preceding)""",
    ),
    "pose_carry_forward": Query(
        pose_carry_forward,
        f"""with {DETECTIONS}, c as (select *, max(case when event_id % 3 = 0 then event_id end) over (partition by video, track order by event_id) src from detections)
select c.video, c.track track_id, c.event_id, case when s.event_id % 2 = 0 then s.conf end pose from c left join detections s on s.event_id = c.src""",
    ),
    "event_overlay": Query(
        event_overlay,
        """with t as (select event_id, (epoch_us(ts) // 1000) % 86400000 / 1000.0::double t from events)
select event_id, n_name "name" from t join nation on n_nationkey * 3000 <= t and t < n_nationkey * 3000 + 1800 + n_regionkey * 900""",
    ),
    "legacy_track_step": Query(
        legacy_track_step,
        f"""with {BOXES}, {pairs_sql(0, 1, 0.3)},
best as (select image_id, ib, ia from (select *, row_number() over (partition by image_id, ib order by iou desc, ia) r from pairs) where r = 1),
c as (select n.image_id, n.idx, b.ia, coalesce(o.old, 0) old from boxes n left join best b on b.image_id = n.image_id and b.ib = n.idx
  left join (select image_id, max(idx) + 1 old from boxes where src = 0 group by all) o on o.image_id = n.image_id where n.src = 1),
d as (select *, ia is not null and row_number() over (partition by image_id, ia order by idx) = 1 owns from c)
select image_id, idx, case when owns then ia else old + sum((not owns)::int) over (partition by image_id order by idx) - 1 end::bigint track,
  case when ia is not null then 2 else 1 end life from d""",
    ),
    "iou_track": Query(iou_track),
    "reid_track": Query(reid_track),
    "track_histories": Query(track_histories),
    "pose_gate": Query(
        pose_gate,
        f"""with recursive {DETECTIONS},
seen as (select video, track, frame_idx, arg_min(cls, event_id) cls, 0.3 + min(event_id) % 8 / 16.0::double aspect from detections group by all),
o as materialized (select *, row_number() over (partition by video, track order by frame_idx) k from seen where cls = 0),
walk as (
  select video, track, frame_idx, k, false due, frame_idx last_seen, -1::bigint last_pose, -1.0::double last_aspect from o where k = 1
  union all
  select video, track, frame_idx, k, due, frame_idx, case when due then frame_idx else last_pose end, case when due then aspect else last_aspect end
  from (
    select o.video, o.track, o.frame_idx, o.k, o.aspect, w.last_pose, w.last_aspect,
      w.last_pose < 0 or o.frame_idx - w.last_pose >= 5 or abs(o.aspect - w.last_aspect) > 0.3 or o.frame_idx - w.last_seen > 1 due
    from walk w join o on o.video = w.video and o.track = w.track and o.k = w.k + 1))
select video, track track_id, frame_idx, due from walk union all select video, track, frame_idx, false from seen where cls <> 0""",
    ),
    "track_summary": Query(track_summary, f"with {DETECTIONS} select video, count(distinct track) n_tracks, count(*) n_objects, max(ts_ms) - min(ts_ms) duration_ms from detections group by all"),
    "window_tumbling": Query(window_tumbling, "select epoch_ms(date_trunc('hour', ts)) start_ms, event_type, count(*) n from events group by all"),
    "window_sliding": Query(
        window_sliding,
        """select epoch_ms(date_trunc('hour', ts)) - k * 3600000 start_ms, count(*) n, count(distinct user_id) users from events, (select unnest([0, 1]) k) group by all""",
    ),
    "session_gap": Query(
        session_gap,
        """with g as (select user_id, epoch_us(ts) // 1000 ms, ts, lag(ts) over (partition by user_id order by ts) was from events),
s as (select user_id, ms, ts, sum(case when was is null or ts - was >= interval 30 minutes then 1 else 0 end) over (partition by user_id order by ts) k from g)
select user_id, min(ms) start_ms, count(*) n from s group by user_id, k""",
    ),
}
