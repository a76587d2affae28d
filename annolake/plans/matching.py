"""Queries over boxes: matching, consensus, disputes, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from annolake.operators import evaluation, exports, matching
from annolake.plans.fixtures import BOXES, COVERAGE, GREEDY, IOU, boxes, coverage, pairs_sql
from annolake.plans.query import Query

WEIGHTS = {1: 0.25, 2: 0.375, 3: 0.375}
NINE = lambda c: (F.round(c, 9) + 0.0).alias(c)


def iou_pairs(spark, d):
    return matching.iou_pairs(boxes(spark, d), 0, 1, 0.3)


def greedy_match(spark, d):
    return matching.greedy_match(matching.iou_pairs(boxes(spark, d), 0, 1, 0.3))


def iou_exists_match(spark, d):
    return matching.same_everywhere(boxes(spark, d), 0, 1, 0.5)


def detection_eval(spark, d):
    out = evaluation.detection_measures(boxes(spark, d), 0, 1, 0.5)
    return out.select("n_gt", "n_det", "tp", NINE("recall"), NINE("precision"), NINE("f1"), NINE("mean_iou"), "label_ok", "label_total")


def null_aware_join(spark, d):
    return matching.null_aware_join(boxes(spark, d), coverage(spark, d))


def fp_votes(spark, d):
    return matching.votes(boxes(spark, d), 0, WEIGHTS, 0.7, 3)


def consensus(spark, d):
    out = matching.consensus(boxes(spark, d), [1, 2, 3], 0.3, 2)
    return out.select("image_id", "seed_src", "seed_idx", F.size("supporters").alias("n_supporters"))


def dispute_score(spark, d):
    out = matching.dispute_scores(boxes(spark, d), coverage(spark, d), 0, WEIGHTS, 0.3, 2)
    return out.select("image_id", NINE("score"), "n_fp", "n_fn")


def sample_class(spark, d):
    return matching.sample_class(boxes(spark, d), 0, 1, 0.3)


def _fp_scores(spark, d):
    return matching.votes(boxes(spark, d), 0, WEIGHTS, 0.7, 3).groupBy("image_id").agg(F.sum("fp").alias("score"))


def cascade_review(spark, d):
    return matching.review_set(_fp_scores(spark, d), 0.3)


def cascade_counts(spark, d):
    return cascade_review(spark, d).groupBy("route").agg(F.count("*").alias("n"))


def label_files(spark, d):
    b = boxes(spark, d)
    rows = b.where("src = 1").select("image_id", "idx", (F.col("cls") - 1).alias("class_id"), ((F.col("x1") + F.col("x2")) / 2).alias("cx"), ((F.col("y1") + F.col("y2")) / 2).alias("cy"), (F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h"))
    images = b.select("image_id").distinct().withColumns({"x": F.lit(0.125), "y": F.lit(0.0), "w": F.lit(0.75), "h": F.lit(0.875)})
    return exports.label_files(images, rows, "image_id", crop=("x", "y", "w", "h")).select("image_id", "content", "n_objects")


def mining_report(spark, d):
    """One row about the routed images and those that a source failed for."""
    failed = coverage(spark, d).where("not ok").select("image_id").distinct()
    routed = cascade_review(spark, d).join(failed, "image_id", "left_anti")
    return exports.mining_report(routed, failed, {"iou": 0.7, "consensus": 3})


VOTES = f"""
near as (
  select distinct a.image_id, a.idx, b.src from boxes a join boxes b on a.image_id = b.image_id and a.src = 0 and b.src in (1, 2, 3) where {IOU} >= 0.7),
voted as (select image_id, idx, count(*) n, sum(case src when 1 then 0.25::double else 0.375::double end) w from near group by all),
votes as (
  select b.image_id, b.idx, coalesce(v.n, 0)::bigint n_votes,
    case when coalesce(v.n, 0) < 3 then 1.0::double - coalesce(v.w, 0.0::double) else 0.0::double end fp
  from boxes b left join voted v on v.image_id = b.image_id and v.idx = b.idx where b.src = 0)"""
ROUTES = f"""with {BOXES}, {VOTES},
scores as (select image_id, sum(fp) score from votes group by all),
ranked as (select *, row_number() over (order by score desc, image_id) r, (select count(*) from scores where score > 0) n from scores),
routes as (select image_id, score, case when score <= 0 then 'l0' when r <= floor(n * 0.3) then 'review' else 'l1' end route from ranked)"""

CONSENSUS = f"""
s as (select *, src * 1000000 + idx code from boxes where src in (1, 2, 3)),
alike as (
  select a.image_id, a.code, list({{'src': b.src, 'code': b.code}} order by {IOU} desc, b.idx desc) near
  from s a join s b on a.image_id = b.image_id and a.src <> b.src where {IOU} >= 0.3 group by a.image_id, a.code),
seeds as materialized (
  select image_id, code, coalesce(near, []) near, row_number() over (partition by image_id order by conf desc, src, idx) k from s left join alike using (image_id, code)),
walk as (
  select distinct image_id, 0::bigint k, []::bigint[] used, []::bigint[] got from s
  union all
  select image_id, k, case when len(got) > 0 then used || got else used end, got
  from (
    select w.image_id, o.k, w.used, case when list_contains(w.used, o.code) then []::bigint[] else list_filter([o.code,
      list_filter(o.near, lambda x: x.src = 1 and not list_contains(w.used, x.code))[1].code, list_filter(o.near, lambda x: x.src = 2 and not list_contains(w.used, x.code))[1].code,
      list_filter(o.near, lambda x: x.src = 3 and not list_contains(w.used, x.code))[1].code], lambda c: c is not null) end got
    from walk w join seeds o on o.image_id = w.image_id and o.k = w.k + 1)),
groups as materialized (select image_id, got[1] // 1000000 seed_src, got[1] % 1000000 seed_idx, got from walk where len(got) >= 2)"""

QUERIES = {
    "iou_pairs": Query(iou_pairs, f"with {BOXES}, {pairs_sql(0, 1, 0.3)} select * from pairs"),
    "label_files": Query(
        label_files,
        f"""with {BOXES}, s as (select image_id, idx, cls - 1 c, ((x1 + x2) / 2 - 0.125::double) / 0.75::double cx, ((y1 + y2) / 2) / 0.875::double cy, (x2 - x1) / 0.75::double w, (y2 - y1) / 0.875::double h from boxes where src = 1)
select image_id, coalesce(string_agg(printf('%d %.6f %.6f %.6f %.6f', c, cx, cy, w, h) || chr(10), '' order by idx) filter (where c >= 0), '') content, count(c) n_objects
from (select distinct image_id from boxes) left join s using (image_id) group by image_id""",
    ),
    "mining_report": Query(
        mining_report,
        f"""{ROUTES}, {COVERAGE}, failed as (select distinct image_id from coverage where not ok),
r as (select route from routes where image_id not in (select image_id from failed) union all select 'skipped' from failed)
select count(*) total, count(*) filter (where route = 'skipped') skipped, count(*) filter (where route = 'l0') l0, count(*) filter (where route = 'l1') l1,
  count(*) filter (where route = 'review') review, '{{"iou":0.7,"consensus":3}}' settings from r""",
    ),
    "greedy_match": Query(greedy_match, f"with recursive {BOXES}, {pairs_sql(0, 1, 0.3)}, {GREEDY} select * from matched"),
    "iou_exists_match": Query(
        iou_exists_match,
        f"""with {BOXES}, {pairs_sql(0, 1, 0.5)},
sizes as (select image_id, count(*) filter (src = 0) na, count(*) filter (src = 1) nb from boxes group by all),
met as (select image_id, count(distinct ia) met from pairs group by all)
select image_id, na = nb and coalesce(met, 0) = na same from sizes left join met using (image_id) where na > 0 or nb > 0""",
    ),
    "detection_eval": Query(
        detection_eval,
        f"""with recursive {BOXES}, {pairs_sql(0, 1, 0.5)}, {GREEDY},
c as (select count(*) filter (src = 0) n_gt, count(*) filter (src = 1) n_det from boxes),
m as (select count(*) tp, avg(m.iou) mean_iou, count(*) filter (cls_a = cls_b) label_ok from matched m join pairs using (image_id, ia, ib)),
r as (select *, tp / greatest(n_gt, 1) recall, tp / greatest(n_det, 1) "precision" from c, m)
select n_gt, n_det, tp, round(recall, 9) recall, round("precision", 9) "precision", round(2 * recall * "precision" / (recall + "precision"), 9) f1,
  round(mean_iou, 9) mean_iou, label_ok, tp label_total from r""",
    ),
    "null_aware_join": Query(
        null_aware_join,
        f"""with {BOXES}, {COVERAGE}, n as (select image_id, src, count(*) n from boxes group by all)
select image_id, count(*) sources, sum(coalesce(n, 0))::bigint n_boxes from coverage left join n using (image_id, src) group by image_id having bool_and(ok)""",
    ),
    "fp_votes": Query(fp_votes, f"with {BOXES}, {VOTES} select * from votes"),
    "consensus": Query(consensus, f"with recursive {BOXES}, {CONSENSUS} select image_id, seed_src::int seed_src, seed_idx, len(got)::int n_supporters from groups"),
    "dispute_score": Query(
        dispute_score,
        f"""with recursive {BOXES}, {COVERAGE}, {VOTES.replace('0.7', '0.3').replace('< 3', '< 2')}, {CONSENSUS},
images as (select image_id from coverage group by image_id having bool_and(ok)),
missed as (
  select g.image_id, list_sum(list_transform(got, lambda c: case c // 1000000 when 1 then 0.25::double else 0.375::double end)) w
  from groups g join boxes a on a.image_id = g.image_id and a.src = seed_src and a.idx = seed_idx
  where not exists (select 1 from boxes b where b.image_id = a.image_id and b.src = 0 and {IOU} >= 0.3)),
fp as (select image_id, sum(fp) fp, count(*) filter (where n_votes < 2) n_fp from votes group by image_id),
fn as (select image_id, sum(w) fn, count(*) n_fn from missed group by image_id)
select image_id, round(coalesce(fp, 0) + coalesce(fn, 0), 9) score, coalesce(n_fp, 0) n_fp, coalesce(n_fn, 0) n_fn from images left join fp using (image_id) left join fn using (image_id)""",
    ),
    "sample_class": Query(
        sample_class,
        f"""with recursive {BOXES}, {pairs_sql(0, 1, 0.3)}, {GREEDY},
sizes as (select image_id, count(*) filter (src = 0) nt, count(*) filter (src = 1) nr from boxes group by all),
m as (select image_id, count(*) m from matched group by all)
select image_id, case when nt = 0 and nr = 0 then 'drop_empty' when nr = 0 then 'negative' when nt = 0 then 'positive'
  when coalesce(m, 0) = nt and coalesce(m, 0) = nr then 'drop_agree' else 'positive' end kind from sizes left join m using (image_id)""",
    ),
    "cascade_review_topk": Query(cascade_review, f"{ROUTES} select * from routes"),
    "cascade_counts": Query(cascade_counts, f"{ROUTES} select route, count(*) n from routes group by all"),
}
