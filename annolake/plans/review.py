"""Queries of box arithmetic and review rules, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annolake.functions import geometry as geo
from annolake.operators import review
from annolake.plans.fixtures import BOXES, boxes, table
from annolake.plans.query import Query


def picture():
    """Width and height; columns can only be made once there is a session."""
    return F.lit(640.0), F.lit(480.0)


def nine(**columns):
    return [F.round(c, 9).alias(n) for n, c in columns.items()]


def named(box, names=("x1", "y1", "x2", "y2")):
    return nine(**dict(zip(names, box, strict=True)))


def _of(spark, d, src):
    return boxes(spark, d).where(F.col("src") == src)


def _yolo(b):
    x1, y1, x2, y2 = geo.corners()
    return b.select("*", ((x1 + x2) / 2).alias("cx"), ((y1 + y2) / 2).alias("cy"), (x2 - x1).alias("w"), (y2 - y1).alias("h"))


def rect_iou(spark, d):
    a, b = (_yolo(_of(spark, d, k)).select("image_id", "idx", F.struct("x1", "y1", "w", "h").alias(n)) for k, n in ((1, "a"), (2, "b")))
    sides = [tuple(F.col(n)[c] for c in ("x1", "y1", "w", "h")) for n in ("a", "b")]
    return a.join(b, ["image_id", "idx"]).select("image_id", "idx", *nine(iou=geo.iou_of_rects(*sides)))


def yolo_rect_clip(spark, d):
    y = _yolo(_of(spark, d, 1))
    rect = geo.rect_of_yolo(F.col("cx") * 1.5 - 0.25, F.col("cy") * 1.5 - 0.25, F.col("w"), F.col("h"))
    return y.select("image_id", "idx", *named(rect, ("x", "y", "w", "h"))).where("w > 0 and h > 0")


def rect_forms(spark, d):
    s = _of(spark, d, 1).selectExpr("image_id", "idx", "x1 * 500 - 20 as x", "y1 * 500 - 20 as y", "(x2 - x1) * 500 as w", "(y2 - y1) * 500 as h")
    rect = tuple(F.col(c) for c in "xywh")
    whole = [c.alias(n) for c, n in zip(geo.whole_corners(*rect), ("px1", "py1", "px2", "py2"), strict=True)]
    return s.select("image_id", "idx", *named(geo.yolo_plain(*rect, *picture()), ("cx", "cy", "bw", "bh")), *whole)


def border_extend(spark, d):
    return _of(spark, d, 2).select("image_id", "idx", *named(geo.widened(geo.corners(), 0.25, 0.5, 0.125, 0.0)))


def padded_crop(spark, d):
    x1, y1, x2, y2 = geo.corners()
    box = geo.padded_in_turn((x1 * 640, y1 * 480, x2 * 640, y2 * 480), 0.25, *picture())
    return _of(spark, d, 2).select("image_id", "idx", *named(box))


def even_crop(spark, d):
    box = geo.padded_evenly(F.col("cx"), F.col("cy"), F.col("w"), F.col("h"), 0.125, *picture())
    rows = _yolo(_of(spark, d, 1)).select("image_id", "idx", *[c.alias(n) for c, n in zip(box, ("x1", "y1", "x2", "y2"), strict=True)])
    rows = rows.where("x2 - x1 >= 96 and y2 - y1 >= 72")
    return rows.select("image_id", "idx", *[F.col(c).cast("long").alias(c) for c in ("x1", "y1", "x2", "y2")])


def roi_crop(spark, d):
    window = geo.region_window(geo.corners(), *picture())
    seen = geo.in_window(F.array(F.struct(((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"))), window)
    return _of(spark, d, 0).select("image_id", "idx", *[c.alias(n) for c, n in zip(window, "xywh", strict=True)], seen[0]["x"].alias("px"), seen[0]["y"].alias("py"))


def polygon_moves(spark, d):
    points = geo.moved(geo.vertexes(geo.corners()), F.lit(0.25), F.lit(-0.125))
    around = geo.envelope(points)
    return _of(spark, d, 3).select("image_id", "idx", F.size(points).alias("n"), points[2]["x"].alias("x"), points[2]["y"].alias("y"), around["x1"].alias("left"), around["y1"].alias("top"))


def keypoint_remap(spark, d):
    points = F.when(F.col("idx") != 2, F.array(F.struct((F.col("x1") * 64).alias("x"), (F.col("y1") * 64).alias("y"))))
    out = geo.remapped(points, F.lit(10), F.lit(20), *picture())
    return _of(spark, d, 0).select("image_id", "idx", out[0]["x"].alias("x"), out[0]["y"].alias("y"))


def class_whitelist(spark, d):
    some = boxes(spark, d).where(review.of_classes(F.col("cls"), [0, 2])).groupBy("src").agg(F.count("*").alias("some"))
    every = boxes(spark, d).where(review.of_classes(F.col("cls"), [])).groupBy("src").agg(F.count("*").alias("every"))
    return some.join(every, "src")


def confidence_band(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("image_id"))
    return review.uncertain_frames(orders.join(_of(spark, d, 1), "image_id", "left"), "image_id", "conf", 0.25)


def exclude_if(spark, d):
    value, conf = review.excluded_if(F.col("cls"), F.col("conf"), 0.75)
    return _of(spark, d, 1).select("image_id", "idx", value.alias("value"), conf.alias("conf"))


def confidence_labels(spark, d):
    conf = F.col("conf") * 1.25
    return _of(spark, d, 1).select("image_id", "idx", review.percent(conf).alias("percent"), review.percent_label(conf).alias("label"))


def renumber(spark, d):
    rows = boxes(spark, d).where("src = 0 and cls <> 1")
    return review.renumbered(rows, "image_id", "idx").select("image_id", "idx", "id", "next_id")


def uncertain_review(spark, d):
    rows = table(spark, d, "embeddings").select("vec_id", F.slice(F.col("embedding").cast("array<double>"), 1, 8).alias("p"), "label")
    rows = rows.withColumn("p", F.when(F.col("label") == 3, F.array().cast("array<double>")).otherwise(F.col("p")))
    top = F.array_max("p")
    kind = F.when(F.size("p") == 0, "empty").when(top > 0.15, "sure").otherwise("review")
    return rows.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))


def priority_pick(spark, d):
    per = boxes(spark, d).where("src > 0").groupBy("image_id", "idx").agg(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("m"), F.col("src").cast("string")), "conf"))).alias("by"))
    return per.select("image_id", "idx", review.first_present(F.col("by"), ["m3", "m1", "m2"]).alias("conf"))


def mean_box(spark, d):
    rows = boxes(spark, d).where("src > 0")
    out = review.mean_boxes(rows, ["image_id", "cls"], "conf")
    return out.select("image_id", "cls", *geo.corners(), "conf", "weights")


def file_counts(spark, d):
    folder = F.element_at(F.split("url", "/"), 3)
    return table(spark, d, "pages").rollup(folder.alias("folder")).agg(F.count("*").alias("n"))


def label_rate(spark, d):
    known = table(spark, d, "labels")
    return known.agg(F.count("*").alias("n"), F.round(F.sum("toxic") / F.count("*"), 4).alias("rate"))


def serial_names(spark, d):
    rows = review.numbered(_of(spark, d, 1), "image_id", "idx")
    return rows.select("image_id", "idx", "part", "serial")


def tile_orders(spark, d):
    rows, by = _of(spark, d, 1), W.partitionBy("image_id")
    orders = {"up": F.col("conf").asc(), "down": F.col("conf").desc(), "kind": F.col("cls").asc()}
    return rows.select("image_id", "idx", *[F.row_number().over(by.orderBy(o, "idx")).alias(n) for n, o in orders.items()])


def misclassified_first(spark, d):
    v = F.slice(F.col("embedding").cast("array<double>"), 1, 10)
    rows = table(spark, d, "embeddings").select("vec_id", "label", F.array_max(v).alias("conf"), (F.array_position(v, F.array_max(v)) - 1).cast("int").alias("top"))
    return review.worst_first(rows, "label", "top", "conf", "vec_id", 0.2, 50).select("vec_id", "label", "top", "conf")


def first_n(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_name").orderBy("p_name", "p_partkey").limit(40)


def largest_part(spark, d):
    size = geo.area(geo.corners())
    best = F.max_by(F.struct("idx", size.alias("area")), F.struct(size, -F.col("idx")))
    return boxes(spark, d).groupBy("image_id", "src").agg(best.alias("b")).select("image_id", "src", "b.idx", "b.area")


def left_to_right(spark, d):
    rows = _of(spark, d, 2).groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("x1", "idx"))).alias("r"))
    return rows.select("image_id", F.concat_ws(",", F.transform("r", lambda r: r["idx"].cast("string"))).alias("in_order"))


def feature_frames(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding")[0].cast("double").alias("first"))
    return e.where("label < 3").unionByName(e.where("label >= 3 and vec_id % 2 = 0"))


OF = "with {b}, s as (select *, (x1 + x2) / 2 cx, (y1 + y2) / 2 cy, x2 - x1 w, y2 - y1 h from boxes where src = {k})"
FIRST = {k: OF.format(b=BOXES, k=k) for k in range(4)}

QUERIES = {
    "rect_iou": Query(
        rect_iou,
        f"""with {BOXES}, p as (select a.image_id, a.idx, greatest(a.x1, b.x1) l, greatest(a.y1, b.y1) t, least(a.x2, b.x2) r, least(a.y2, b.y2) e,
  (a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) both_areas from boxes a join boxes b using (image_id, idx) where a.src = 1 and b.src = 2)
select image_id, idx, round(case when r <= l or e <= t then 0.0::double else (r - l) * (e - t) / (both_areas - (r - l) * (e - t)) end, 9) iou from p""",
    ),
    "yolo_rect_clip": Query(
        yolo_rect_clip,
        f"""{FIRST[1]}, c as (select image_id, idx, greatest(0.0::double, cx * 1.5::double - 0.25::double - w / 2) x, greatest(0.0::double, cy * 1.5::double - 0.25::double - h / 2) y,
  least(1.0::double, cx * 1.5::double - 0.25::double + w / 2) x2, least(1.0::double, cy * 1.5::double - 0.25::double + h / 2) y2 from s)
select image_id, idx, round(x, 9) x, round(y, 9) y, round(x2 - x, 9) w, round(y2 - y, 9) h from c where x2 > x and y2 > y""",
    ),
    "rect_forms": Query(
        rect_forms,
        f"""with {BOXES}, s as (select image_id, idx, x1 * 500 - 20 x, y1 * 500 - 20 y, (x2 - x1) * 500 w, (y2 - y1) * 500 h from boxes where src = 1)
select image_id, idx, round((x + w / 2) / 640, 9) cx, round((y + h / 2) / 480, 9) cy, round(w / 640, 9) bw, round(h / 480, 9) bh,
  trunc(x)::bigint px1, trunc(y)::bigint py1, trunc(x + w)::bigint px2, trunc(y + h)::bigint py2 from s""",
    ),
    "border_extend": Query(
        border_extend,
        f"{FIRST[2]} select image_id, idx, round(x1 - w * 0.25::double, 9) x1, round(y1 - h * 0.5::double, 9) y1, round(x2 + w * 0.125::double, 9) x2, round(y2, 9) y2 from s",
    ),
    "padded_crop": Query(
        padded_crop,
        f"""{FIRST[2]}, a as (select image_id, idx, x1 * 640 - w * 640 * 0.25::double l, y1 * 480 - h * 480 * 0.25::double t, x2 * 640 r, y2 * 480 e from s)
select image_id, idx, round(greatest(0, l), 9) x1, round(greatest(0, t), 9) y1, round(least(640, r + (r - l) * 0.25::double), 9) x2, round(least(480, e + (e - t) * 0.25::double), 9) y2 from a""",
    ),
    "even_crop": Query(
        even_crop,
        f"""{FIRST[1]}, c as (select image_id, idx, greatest(0, (cx - w / 2 - w * 0.125::double) * 640) x1, greatest(0, (cy - h / 2 - h * 0.125::double) * 480) y1,
  least(640, (cx + w / 2 + w * 0.125::double) * 640) x2, least(480, (cy + h / 2 + h * 0.125::double) * 480) y2 from s)
select image_id, idx, trunc(x1)::bigint x1, trunc(y1)::bigint y1, trunc(x2)::bigint x2, trunc(y2)::bigint y2 from c where x2 - x1 >= 96 and y2 - y1 >= 72""",
    ),
    "roi_crop": Query(
        roi_crop,
        f"""{FIRST[0]}, a as (select *, greatest(0, x1 * 640 - 4) l, greatest(0, y1 * 480 - 4) t, least(640, x2 * 640 + 4) r, least(480, y2 * 480 + 4) e from s),
n as (select image_id, idx, cx, cy, l / 640 x, t / 480 y, floor(trunc(r - l) / 4) * 4 / 640 w, floor(trunc(e - t) / 4) * 4 / 480 h from a)
select image_id, idx, x, y, w, h, (cx - x) / w px, (cy - y) / h py from n""",
    ),
    "polygon_moves": Query(
        polygon_moves, f"""{FIRST[3]} select image_id, idx, 4 n, x2 + 0.25::double x, y2 - 0.125::double y, x1 + 0.25::double "left", y1 - 0.125::double top from s"""
    ),
    "keypoint_remap": Query(
        keypoint_remap,
        f"""{FIRST[0]} select image_id, idx, case when idx <> 2 then (x1 * 64 + 10) / 640 end x, case when idx <> 2 then (y1 * 64 + 20) / 480 end y from s""",
    ),
    "class_whitelist": Query(class_whitelist, f'with {BOXES} select src, count(*) filter (cls in (0, 2)) "some", count(*) "every" from boxes group by src'),
    "confidence_band": Query(
        confidence_band,
        f"""with {BOXES} select o_orderkey image_id, min(conf) min_conf from orders join boxes on image_id = o_orderkey and src = 1 group by o_orderkey having min(conf) <= 0.25""",
    ),
    "exclude_if": Query(
        exclude_if,
        f"""{FIRST[1]} select image_id, idx, case when conf > 0.75 and conf <= 1 then -2 else cls end "value", case when conf > 0.75 and conf <= 1 then -1.0::double else conf end conf from s""",
    ),
    "confidence_labels": Query(
        confidence_labels,
        f"""{FIRST[1]}, c as (select image_id, idx, trunc(conf * 1.25::double * 100)::int p from s)
select image_id, idx, p "percent", case when p < 80 or p > 100 then '(' || p || ')' else '' end "label" from c""",
    ),
    "renumber": Query(
        renumber,
        f"""with {BOXES} select image_id, idx, row_number() over (partition by image_id order by idx) id, count(*) over (partition by image_id) + 1 next_id from boxes where src = 0 and cls <> 1""",
    ),
    "uncertain_review": Query(
        uncertain_review,
        """with p as (select vec_id, case when label = 3 then 'empty' when list_max(embedding[1:8]::double[]) > 0.15::double then 'sure' else 'review' end kind from embeddings)
select kind, count(*) n, min(vec_id) "first" from p group by kind""",
    ),
    "priority_pick": Query(
        priority_pick,
        f"""with {BOXES} select image_id, idx, coalesce(max(conf) filter (src = 3), max(conf) filter (src = 1), max(conf) filter (src = 2)) conf from boxes where src > 0 group by image_id, idx""",
    ),
    "mean_box": Query(
        mean_box,
        f"""with {BOXES} select image_id, cls, {', '.join(f'sum(conf * {c}) / sum(conf) {c}' for c in ('x1', 'y1', 'x2', 'y2'))}, least(sum(conf), 1.0::double) conf, sum(conf) weights
from boxes where src > 0 group by image_id, cls having sum(conf) >= 1""",
    ),
    "file_counts": Query(file_counts, "select split_part(url, '/', 3) folder, count(*) n from pages group by rollup (split_part(url, '/', 3))"),
    "label_rate": Query(label_rate, "select count(*) n, round(sum(toxic) / count(*), 4) rate from labels"),
    "serial_names": Query(serial_names, f"{FIRST[1]} select image_id, idx, '_p' || idx part, '_' || lpad((idx + 1)::varchar, 4, '0') serial from s"),
    "tile_orders": Query(
        tile_orders,
        f"""{FIRST[1]} select image_id, idx, row_number() over (partition by image_id order by conf, idx) "up", row_number() over (partition by image_id order by conf desc, idx) "down",
  row_number() over (partition by image_id order by cls, idx) kind from s""",
    ),
    "misclassified_first": Query(
        misclassified_first,
        """with p as (select vec_id, label, list_max(embedding[1:10]::double[]) conf, (list_position(embedding[1:10]::double[], list_max(embedding[1:10]::double[])) - 1)::int top from embeddings),
k as (select *, case when top <> label then -conf when conf < 0.2 then conf end k from p)
select vec_id, label, top, conf from k where k is not null order by k, top, vec_id limit 50""",
    ),
    "first_n": Query(first_n, "select p_partkey, p_name from part order by p_name, p_partkey limit 40"),
    "largest_part": Query(
        largest_part,
        f"""with {BOXES}, r as (select *, (x2 - x1) * (y2 - y1) area, row_number() over (partition by image_id, src order by (x2 - x1) * (y2 - y1) desc, idx) k from boxes)
select image_id, src, idx, area from r where k = 1""",
    ),
    "left_to_right": Query(left_to_right, f"{FIRST[2]} select image_id, string_agg(idx::varchar, ',' order by x1, idx) in_order from s group by image_id"),
    "feature_frames": Query(feature_frames, """select vec_id, label, embedding[1]::double "first" from embeddings where label < 3 or label >= 3 and vec_id % 2 = 0"""),
}
