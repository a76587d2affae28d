"""Queries over forms of labels, affine maps, table functions and injected stages."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolake.functions import affine, tables
from annolake.operators import conversions, curation, labels, labelsets, stages
from annolake.plans.curation import h32
from annolake.plans.fixtures import BOXES, VECTORS, boxes, table, vectors
from annolake.plans.query import Query

NAMES = ["car", "van"]  # class 2 has no name


def nine(c, name, digits=9):
    return (F.round(c, digits) + 0.0).alias(name)


def affine_points(spark, d):
    """Keypoints of padded crops in the output of 192 x 256, and back."""
    b = boxes(spark, d).where("src = 0")
    w, h = (F.col("x2") - F.col("x1")) * 640, (F.col("y2") - F.col("y1")) * 480
    cx, cy, sw, sh = affine.padded_box(w, h)
    fw, _ = affine.fitted(sw, sh, 192, 256)
    rows = b.select("image_id", "idx", (w * F.col("conf") * 0.7310585786).alias("px"), (h * 0.2689414213).alias("py"), affine.top_down(cx, cy, F.when(F.col("idx") == 3, 0.0).otherwise(fw), 192, 256).alias("m"))
    x, y = affine.moved(F.col("m"), F.col("px"), F.col("py"))
    bx, by = affine.moved(affine.inverse(F.col("m")), x, y)
    same = affine.product(affine.inverse(F.col("m")), F.col("m"))
    return rows.select("image_id", "idx", nine(x, "x", 6), nine(y, "y", 6), nine(bx, "back_x", 6), nine(by, "back_y", 6), nine(same["a"] + same["e"] - 2 + same["b"] + same["c"] + same["d"] + same["f"], "apart"))


def label_forms(spark, d):
    """Boxes as detections, to labels, to label lines and back, to named rows and back."""
    b = boxes(spark, d).where("src = 1")
    rect = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"), (F.col("x2") - F.col("x1")).alias("width"), (F.col("y2") - F.col("y1")).alias("height"))
    label = conversions.of_detection(F.struct(F.col("idx").alias("id"), "cls", "conf", rect.alias("rect")))
    rows = b.select("image_id", "idx", label.alias("label"))
    line = conversions.to_darknet(F.col("label"))
    rows = rows.select("image_id", "idx", "label", line.alias("line"), conversions.to_kitti(F.col("label"), NAMES).alias("row"))
    back = conversions.of_darknet(*[F.col("line")[n] for n in ("class_id", "cx", "cy", "w", "h")])
    named = conversions.of_kitti(F.col("row"), NAMES)
    rows = rows.select("image_id", "idx", "label", "line", "row", back.alias("back"), named.alias("named"))
    p = F.col("named")["polygon"][2]
    return rows.select(
        "image_id", "idx", F.col("label.prob_class.conf").alias("conf"), F.col("line.class_id").alias("cls"), nine(F.col("line.cx"), "cx"), nine(F.col("line.h"), "h"),
        F.col("row.cls").alias("name"), nine(F.col("row.y2"), "y2"), (F.col("back.polygon") == F.col("label.polygon")).alias("same"), F.col("named.prob_class.value").alias("named"),
        nine(p["x"] + p["y"], "corner"), F.col("back.prob_class.conf").alias("sure"),
    )


def legacy_results(spark, d):
    """Results of the older format, written as text and read through VARIANT, as labels with their likeliest properties."""
    b = boxes(spark, d).where("src = 2")
    rect = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"), (F.col("x2") - F.col("x1")).alias("width"), (F.col("y2") - F.col("y1")).alias("height"))
    props = F.create_map(F.lit("3"), F.array(F.lit(0.25), F.col("conf"), F.lit(0.5)), F.lit("7"), F.array(F.lit(1.0)))
    one = F.struct(F.col("idx").alias("id"), "cls", "conf", rect.alias("rect"), props.alias("props"))
    texts = b.groupBy("image_id").agg(F.collect_list(F.to_json(one)).alias("each"))
    text = F.when(F.col("image_id") % 10 == 0, "no json").otherwise(F.concat(F.lit('{"roi": [], "objects": ['), F.array_join("each", ","), F.lit("]}")))
    rows = texts.select("image_id", conversions.result_of(text).alias("r"))
    objects = rows.select("image_id", F.explode_outer("r.objects").alias("o"))
    label = F.when(F.col("o").isNotNull(), conversions.of_result(F.col("o")))
    return objects.select("image_id", label.alias("l")).select(
        "image_id", F.col("l.id").alias("idx"), F.col("l.prob_class.value").alias("cls"), F.col("l.prob_class.conf").alias("conf"),
        F.col("l.properties")[3]["value"].alias("p3"), F.col("l.properties")[3]["conf"].alias("c3"), F.col("l.properties")[7]["value"].alias("p7"), nine(F.col("l.polygon")[2]["x"], "x2"),
    )


def tiles_lateral(spark, d):
    tables.register(spark)
    table(spark, d, "part").selectExpr("p_partkey", "cast(p_size * 10 + 320 as int) w", "cast(p_size * 3 + 240 as int) h").createOrReplaceTempView("pictures_to_cut")
    return spark.sql("select p_partkey, t.k, t.x, t.y, t.w, t.h from pictures_to_cut p, lateral tiles(p.w, p.h, 3, 2) t")


def times_lateral(spark, d):
    tables.register(spark)
    table(spark, d, "supplier").selectExpr("s_suppkey", "cast(s_nationkey * 4 as double) length", "cast(s_suppkey % 5 + 1 as int) n").createOrReplaceTempView("clips")
    return spark.sql("select s_suppkey, t.k, round(t.at, 9) at from clips c, lateral times(c.length, c.n) t")


def neighbours_lateral(spark, d):
    tables.register(spark)
    table(spark, d, "conversations").selectExpr("conv_id", "turn", "turn as item").createOrReplaceTempView("turns_in_order")
    return spark.sql("select conv_id, before, item from neighbours(table(turns_in_order), 'conv_id', 'turn', 'item')")


class Linear:
    """A stage with fixed weights that cannot take some rows."""

    def __init__(self):
        self.weights = [((k * 7) % 11 - 5) / 8 for k in range(64)]

    def __call__(self, rows: list[dict]) -> list:
        if any(r["vec_id"] % 17 == 0 for r in rows):
            raise ValueError("unreadable")
        return [sum(w * x for w, x in zip(self.weights, r["v"], strict=True)) for r in rows]


def stage_scores(spark, d):
    v = vectors(spark, d).select("vec_id", F.when(F.col("vec_id") % 23 != 0, F.col("v")).alias("v"))
    rows = v.select(F.col("vec_id").alias("own"), F.when(F.col("v").isNotNull(), F.col("vec_id")).alias("vec_id"), "v")
    out = stages.staged(rows, "linear", Linear, ["vec_id", "v"], T.DoubleType())
    return out.select(F.col("own").alias("vec_id"), nine(F.col("result"), "score"), "error")


def grid_decode(spark, d):
    """Vectors as an 8 by 8 grid of four planes, decoded to boxes of a picture of 128 by 128."""
    v = vectors(spark, d)
    plane = lambda k: F.transform(F.concat(F.slice("v", k + 1, 64 - k), F.slice("v", 1, k)) if k else F.col("v"), lambda x: F.abs(x))
    found = labels.grid_boxes(*[plane(k) for k in (0, 5, 11, 23)], 8, 16, 35, 128, 128)
    rows = v.select("vec_id", F.posexplode(found).alias("k", "b"))
    return rows.where("k % 9 = 4").select("vec_id", "k", *[nine(F.col("b")[c], c) for c in ("x1", "y1", "x2", "y2")])


def sharpness(spark, d):
    return vectors(spark, d).select("vec_id", nine(labels.sharpness(F.transform("v", lambda x: x * 8), 8), "sharpness"))


def union_boxes(spark, d):
    return labelsets.union_boxes(boxes(spark, d).where("src = 1").withColumn("cls", F.col("cls") - 1), "image_id")


def label_places(spark, d):
    p = table(spark, d, "part")
    name = F.concat_ws("_", F.lit("/2021/a"), F.when(F.col("p_partkey") % 3 > 0, F.col("p_partkey").cast("string")), F.lit("s31.lbl"))
    name = F.when(F.col("p_partkey") % 7 == 0, F.lit("plain.lbl")).otherwise(name)
    image = F.concat(F.lit("set/images/x."), F.col("p_partkey").cast("string"), F.lit(".jpg"))
    return p.select("p_partkey", labelsets.image_of_label(name, ".jpg").alias("image"), labelsets.darknet_label_path(image).alias("darknet"))


def merged_splits(spark, d):
    b = boxes(spark, d)
    split = F.when(F.col("idx") == 0, "train").when(F.col("idx") == 1, "valid").when(F.col("idx") == 2, "test").otherwise("other")
    source = lambda k: b.where(F.col("src") == k).select(F.col("image_id").alias("stem"), "cls", split.alias("part"))
    classes = spark.createDataFrame([("a", 0, 5), ("a", 1, 6), ("b", 2, 5)], "source string, cls int, to int")
    return curation.merged({"a": source(1), "b": source(2)}, classes, "part")


def combo_members(spark, d):
    nations = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).where("r_name <> 'ASIA'")
    return curation.combination_members(curation.combinations(table(spark, d, "region"), "r_name"), nations, "r_name", "n_name", 3, 7)


def late_events(spark, d):
    e = table(spark, d, "events").select("event_id", (F.col("event_id") % 100 / 4).alias("end_s"), (F.col("user_id") % 20).cast("double").alias("duration_s"))
    return labelsets.beyond_the_end(e, "end_s", "duration_s").select("event_id")


def local_times(spark, d):
    o = table(spark, d, "orders")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    iso = F.when(F.col("o_orderkey") % 3 == 0, F.concat(iso, F.lit("+02:00"))).when(F.col("o_orderkey") % 3 == 1, iso).otherwise("yesterday")
    return o.select("o_orderkey", labelsets.local_time(iso, "Asia/Shanghai").alias("local"))


QUERIES = {
    "grid_decode": Query(
        grid_decode,
        f"""with {VECTORS}, c as (select vec_id, v, unnest([4, 13, 22, 31, 40, 49, 58])::int k from vectors),
p as (select vec_id, k, k % 8 * 16 + 0.5::double cx, k // 8 * 16 + 0.5::double cy, abs(v[k + 1]) * 35 l, abs(v[(k + 5) % 64 + 1]) * 35 t, abs(v[(k + 11) % 64 + 1]) * 35 r, abs(v[(k + 23) % 64 + 1]) * 35 b from c)
select vec_id, k, round(greatest(0, least(128, cx - l)), 9) x1, round(greatest(0, least(128, cy - t)), 9) y1, round(greatest(0, least(128, cx + r)), 9) x2, round(greatest(0, least(128, cy + b)), 9) y2 from p""",
    ),
    "sharpness": Query(
        sharpness,
        f"""with {VECTORS}, c as (select vec_id, list_transform(v, lambda x: x * 8) v, unnest(range(64)) k from vectors),
n as (select vec_id, v, k, k % 8 x, k // 8 y from c),
m as (select vec_id, v[k + 1] own, v[y * 8 + abs(x - 1) + 1] w, v[y * 8 + 7 - abs(7 - x - 1) + 1] e, v[abs(y - 1) * 8 + x + 1] u, v[(7 - abs(7 - y - 1)) * 8 + x + 1] b from n)
select vec_id, round(var_pop(w + e + u + b - 4 * own), 9) sharpness from m group by vec_id""",
    ),
    "union_boxes": Query(union_boxes, f"with {BOXES} select image_id, min(x1) x1, min(y1) y1, max(x2) x2, max(y2) y2 from boxes where src = 1 and cls >= 1 group by image_id"),
    "label_places": Query(
        label_places,
        """select p_partkey, case when p_partkey % 7 > 0 then '/2021/a' || case when p_partkey % 3 > 0 then '_' || p_partkey else '' end || '.jpg' end image, 'set/labels/x.' || p_partkey || '.txt' darknet from part""",
    ),
    "merged_splits": Query(
        merged_splits,
        f"""with {BOXES}, renumber as (select * from (values ('a', 1, 0, 5), ('a', 1, 1, 6), ('b', 2, 2, 5)) t(origin, s, k, goes))
select origin || '_' || image_id stem, goes cls, origin source, case when idx = 0 then 'train' else 'valid' end split from boxes join renumber on src = s and cls = k where idx in (0, 1, 2)""",
    ),
    "combo_members": Query(
        combo_members,
        f"""with m as (select r_name, n_name, row_number() over (partition by r_name order by n_name) r from nation join region on n_regionkey = r_regionkey where r_name <> 'ASIA'),
p as (select * from m where r <= 3), n as (select r_name, max(r) n from p group by r_name), g as (select r_name from region),
c as (select a.r_name || '+' || b.r_name combo, [a.r_name, b.r_name] names from g a join g b on b.r_name > a.r_name
  union all select a.r_name || '+' || b.r_name || '+' || c.r_name, [a.r_name, b.r_name, c.r_name] from g a join g b on b.r_name > a.r_name join g c on c.r_name > b.r_name),
x as (select combo, unnest(names) r_name from c where not list_contains(names, 'ASIA'))
select combo, x.r_name, n_name from x join n on n.r_name = x.r_name join p on p.r_name = x.r_name and p.r = {h32(7, 'combo', 'x.r_name')} % n.n + 1""",
    ),
    "late_events": Query(late_events, "select event_id from events where event_id % 100 / 4.0::double > user_id % 20"),
    "local_times": Query(
        local_times,
        "select o_orderkey, case o_orderkey % 3 when 0 then strftime(o_orderdate + interval 6 hours, '%Y-%m-%d %H:%M:%S') when 1 then strftime(o_orderdate + interval 8 hours, '%Y-%m-%d %H:%M:%S') end \"local\" from orders",
    ),
    "affine_points": Query(
        affine_points,
        f"""with {BOXES}, s as (select image_id, idx, (x2 - x1) * 640 w, (y2 - y1) * 480 h, conf from boxes where src = 0),
p as (select image_id, idx, w, h, w * conf * 0.7310585786::double px, h * 0.2689414213::double py, case when idx = 3 then 0 when w * 1.25::double * 256 > h * 1.25::double * 192 then w * 1.25::double else h * 1.25::double * 192 / 256 end f from s)
select image_id, idx, round(case when f > 0 then (px - w / 2) * 192 / f + 96 else px end, 6) x, round(case when f > 0 then (py - h / 2) * 192 / f + 128 else py end, 6) y,
  round(px, 6) back_x, round(py, 6) back_y, 0.0::double apart from p""",
    ),
    "label_forms": Query(
        label_forms,
        f"""with {BOXES} select image_id, idx, conf, cls, round((x1 + x2) / 2, 9) cx, round(y2 - y1, 9) h, case cls when 0 then 'car' when 1 then 'van' end "name", round(y2, 9) y2, true same,
  case when cls < 2 then cls end "named", round(x2 + y2, 9) corner, 1.0::double sure from boxes where src = 1""",
    ),
    "legacy_results": Query(
        legacy_results,
        f"""with {BOXES} select image_id, idx::int idx, cls, conf, case when conf >= 0.5 then 1 else 2 end p3, greatest(0.5::double, conf) c3, 0 p7, round(x2, 9) x2
from boxes where src = 2 and image_id % 10 <> 0 union all select distinct image_id, null::int, null::int, null::double, null::int, null::double, null::int, null::double from boxes where src = 2 and image_id % 10 = 0""",
    ),
    "tiles_lateral": Query(
        tiles_lateral,
        """with p as (select p_partkey, (p_size * 10 + 320)::int w, (p_size * 3 + 240)::int h, unnest(range(6))::int k from part)
select p_partkey, k, k % 3 * (w // 3) x, k // 3 * (h // 2) y, w // 3 w, h // 2 h from p""",
    ),
    "times_lateral": Query(
        times_lateral,
        """with s as (select s_suppkey, s_nationkey * 4.0::double length, (s_suppkey % 5 + 1)::int n, unnest(range(s_suppkey % 5 + 1))::int k from supplier)
select s_suppkey, k, round(case when n > 1 then k * length / (n - 1) else 0 end, 9) "at" from s""",
    ),
    "neighbours_lateral": Query(
        neighbours_lateral,
        """select conv_id, before, item from (select conv_id, lag(turn) over (partition by conv_id order by turn) before, turn item, row_number() over (partition by conv_id order by turn) k from conversations) where k > 1""",
    ),
    "stage_scores": Query(
        stage_scores,
        f"""with {VECTORS} select vec_id, case when vec_id % 17 <> 0 and vec_id % 23 <> 0 then round(list_sum(list_transform(range(0, 64), lambda k: ((k * 7) % 11 - 5) / 8.0::double * v[k + 1])), 9) + 0.0 end score,
  case when vec_id % 17 = 0 and vec_id % 23 <> 0 then 'ValueError: unreadable' end error from vectors""",
    ),
}
