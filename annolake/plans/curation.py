"""Queries over datasets, labels and their measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from annolake.functions import geometry, vectors as vec
from annolake.operators import curation, evaluation, labels
from annolake.plans.fixtures import BOXES, boxes, table
from annolake.plans.query import Query

NINE = lambda c, n: (F.round(c, 9) + 0.0).alias(n)


def h32(seed: int, *keys: str) -> str:
    text = " || ':' || ".join(f"{k}::varchar" for k in keys)
    return f"('0x' || md5('{seed}:' || {text})[1:8])::bigint"


def stride_sample(spark, d):
    return curation.stride_sample(table(spark, d, "conversations").select("conv_id", "turn"), "conv_id", ["turn"], 3)


def topn_per_class(spark, d):
    p = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return curation.top_n(p, "o_orderpriority", [F.desc("o_totalprice"), F.col("o_orderkey")], 20)


def hash_sample_per_class(spark, d):
    return curation.random_n(table(spark, d, "part").select("p_partkey", "p_brand"), "p_brand", "p_partkey", 5, seed=3)


def lag_pairs(spark, d):
    c = table(spark, d, "conversations").withColumn("chars", F.length("text"))
    return curation.neighbours(c, "conv_id", "turn", "chars")


def merge_remap(spark, d):
    b = boxes(spark, d)
    source = lambda k: b.where(F.col("src") == k).select(F.col("image_id").alias("stem"), "cls")
    classes = spark.createDataFrame([("a", 0, 5), ("a", 1, 6), ("b", 2, 5)], "source string, cls int, to int")
    return curation.merged({"a": source(1), "b": source(2)}, classes)


def pool_union(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("stem"), "o_orderstatus")
    lab = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("stem"), "l_returnflag")
    return curation.pooled({"f": o.where("o_orderstatus = 'F'"), "o": o.where("o_orderstatus = 'O'")}, {"f": lab.where("l_returnflag = 'R'"), "o": lab.where("l_returnflag = 'A'")})


def quota_fill(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_returnflag").distinct()
    have = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return curation.quota_fill(rows, "l_orderkey", "l_returnflag", [("R", 100), ("A", 200), ("N", 50)], have)


def ratio_split(spark, d):
    return curation.split(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", {"train": 0.8, "val": 0.1, "test": 0.1}, seed=1)


def stratified_split(spark, d):
    return curation.split(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderkey", {"train": 0.8, "val": 0.1, "test": 0.1}, by="o_orderpriority", seed=1)


def orphan_images(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag")
    return curation.orphans(table(spark, d, "orders").select("o_orderkey"), [lines.where("l_returnflag = 'R'"), lines.where("l_returnflag = 'A'")], "o_orderkey")


def label_clean(spark, d):
    ranges = spark.createDataFrame([(0, 0.5, 2.0), (1, None, 1.5), (2, 0.75, None)], "cls int, lo double, hi double")
    b = boxes(spark, d).join(F.broadcast(ranges), "cls")  # three rows
    aspect = (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    corner = lambda x, y: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"))
    roi = F.array(corner(0.25, 0.25), corner(0.75, 0.25), corner(0.75, 0.7501), corner(0.25, 0.7501))
    kept = b.where(curation.in_range(aspect, F.col("lo"), F.col("hi")) & geometry.inside_polygon((F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2, roi))
    return kept.select("image_id", "src", "idx", "cls")


def combos(spark, d):
    return curation.combinations(table(spark, d, "region"), "r_name")


def page_tiles(spark, d):
    return curation.paged(table(spark, d, "part").select("p_partkey", "p_brand"), "p_brand", ["p_partkey"], 12)


def relabel_verify(spark, d):
    b = boxes(spark, d).where("src = 0").select("image_id", "idx", "cls")
    reference = table(spark, d, "orders").selectExpr("o_orderkey as image_id", "cast(o_custkey % 3 as int) as cls").distinct()
    return b.join(reference, ["image_id", "cls"], "left_semi").select("image_id", "idx", "cls")


def augment_fanout(spark, d):
    return curation.augmented(boxes(spark, d).where("src = 0"), 3)


def box_quality_filter(spark, d):
    b, banned = boxes(spark, d), table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("image_id"))
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    right = (w * h).between(0.02, 0.05) & (w <= 0.98) & (h <= 0.98) & (F.greatest(w, h) / F.least(w, h) <= 1.5)
    return b.where(right).join(banned, "image_id", "left_anti").select("image_id", "src", "idx")


def _yolo(spark, d, rule):
    b = boxes(spark, d).where("src = 1").selectExpr("image_id", "idx", "x1 * 1024 - 200 as x", "y1 * 1024 - 100 as y", "(x2 - x1) * 1024 as w", "(y2 - y1) * 1024 as h")
    out = rule(*[F.col(c) for c in "xywh"], F.lit(640.0), F.lit(480.0))
    return b.select("image_id", "idx", *[NINE(v, n) for v, n in zip(out, ("cx", "cy", "bw", "bh"), strict=True)])


def yolo_noclip(spark, d):
    return _yolo(spark, d, geometry.yolo_plain)


def yolo_clip(spark, d):
    return _yolo(spark, d, geometry.yolo_clipped).where("bw > 0 and bh > 0")


def yolo_clamp(spark, d):
    return _yolo(spark, d, geometry.yolo_clamped)


def pixel_boxes(spark, d):
    b = boxes(spark, d).where("src = 2")
    shifted = tuple(F.col(c) * 1.5 - 0.25 for c in ("x1", "y1", "x2", "y2"))
    out = b.select("image_id", "idx", geometry.pixel_box(shifted, F.lit(100), F.lit(80)).alias("p"))
    return out.where("p is not null").select("image_id", "idx", "p.*")


def darknet_parse(spark, d):
    b = boxes(spark, d).where("src = 0")
    yolo = geometry.yolo_of_corners(geometry.corners())
    line = F.concat_ws(" ", F.col("cls").cast("string"), *[v.cast("string") for v in yolo])
    files = b.groupBy("image_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", line.alias("l")))), lambda x: x["l"]), "\n").alias("text"))
    return labels.darknet_lines(files)


def canonical_class(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.concat(F.lit("rmb "), F.col("p_partkey").cast("string"), F.lit(" "), F.col("p_size").cast("string")).alias("name"))
    return p.select("p_partkey", labels.canonical_class(F.col("name")).alias("cls"))


def json_parse(spark, d):
    answer = F.concat(F.lit('<think>x</think> [{"label": "'), F.col("event_type"), F.lit('", "bbox_2d": [10, 20, '), (F.col("user_id") + 30).cast("string"), F.lit(', 900]}, {"bbox": [1]}] done'))
    found = labels.detections_of_answer(answer, F.lit(100.0), F.lit(200.0))
    e = table(spark, d, "events").select("event_id", F.explode(found).alias("f"))
    return e.select("event_id", "f.label", NINE(F.col("f.bbox")[0], "x1"), NINE(F.col("f.bbox")[2], "x2"), NINE(F.col("f.bbox")[3], "y2"), "f.conf")


def prop_map_ops(spark, d):
    e = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    entry = lambda v, c: F.struct(v.alias("value"), c.alias("conf"))
    props = F.create_map(F.lit(1), entry(F.col("k"), F.col("k") / 128), F.lit(2), entry(F.col("k") % 5, (F.col("event_id") % 64) / 64))
    cls = F.when(F.col("event_type") == "error", -1).otherwise(1)
    low = labels.least_conf(cls, F.lit(0.75), props)
    return e.select("event_id", low.alias("min_conf"), F.coalesce(F.element_at(props, F.col("k") % 4)["value"], F.lit(0)).alias("value"))


def simcc_decode(spark, d):
    v = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    out = labels.keypoints(F.slice("v", 1, 32), F.slice("v", 33, 32), 2.0, 0.25)
    return v.select("vec_id", out.alias("p")).select("vec_id", "p.x", "p.y", NINE(F.col("p.conf"), "conf"))


def tile_grid(spark, d):
    o = table(spark, d, "part").select("p_partkey", (F.col("p_partkey") % 640 + 64).alias("w"), (F.col("p_size") + 48).alias("h"))
    return o.select("p_partkey", F.posexplode(labels.tiles(F.col("w"), F.col("h"), 3, 2)).alias("k", "t")).select("p_partkey", "k", F.col("t.x").alias("x"), F.col("t.y").alias("y"), F.col("t.w").alias("w"), F.col("t.h").alias("h"))


def uniform_timestamps(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.explode(labels.uniform_times(F.col("p_partkey") * 1.0, (F.col("p_size") % 5 + 1).cast("int"))).alias("t"))
    return p.select("p_partkey", NINE(F.col("t"), "t"))


def frame_index(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", F.explode(labels.frame_times((F.col("s_suppkey") % 40 + 1).cast("int"), F.lit(25.0), F.lit(10.0))).alias("f"))
    return s.select("s_suppkey", "f.frame_idx", "f.ts_ms")


def class_counts(spark, d):
    return boxes(spark, d).groupBy("src", "cls").agg(F.count("*").alias("n"))


def error_rate_rollup(spark, d):
    e = table(spark, d, "labels").withColumn("guess", (F.col("doc_id") % 2).cast("int"))
    out = evaluation.error_rates(e, "quality", "guess")
    return out.select("class", "n", "errors", NINE(F.col("percent"), "percent"))


def error_histogram(spark, d):
    kinds = F.substring_index("url", ":", 1)
    return table(spark, d, "pages").groupBy(kinds.alias("kind")).agg(F.count("*").alias("n"))


def crosstab_cube(spark, d):
    return evaluation.crosstab(table(spark, d, "documents"), "lang", "source")


def vote_weighted(spark, d):
    e = table(spark, d, "events").withColumn("p", F.array(*[((F.col("event_id") * k + F.col("user_id")) % 64 / 64) for k in (3, 5, 7)]))
    out = evaluation.weighted_vote(e, "user_id", "p", (F.col("event_id") % 4 + 1).cast("double"), 3)
    return out.select("user_id", "top", NINE(F.col("share"), "share"))


def topk_accuracy(spark, d):
    v = table(spark, d, "embeddings").select(F.slice(F.col("embedding").cast("array<double>"), 1, 10).alias("p"), "label")
    return evaluation.topk_accuracy(v, "p", "label", 3).select("n", NINE(F.col("accuracy"), "accuracy"))


def hist256(spark, d):
    return evaluation.histogram(table(spark, d, "orders"), "o_totalprice", 256, 0.0, 524288.0)


def quantile_bin(spark, d):
    return evaluation.quantile_bin(hist256(spark, d), 0.5)


def reduction_ratio(spark, d):
    b = boxes(spark, d).groupBy("image_id").agg(F.count("*").alias("n"))
    return b.agg(F.count("*").alias("n"), F.count_if(F.col("n") > 8).alias("kept")).select("n", "kept", NINE(1 - F.col("kept") / F.col("n"), "reduction"))


def outlier_rate(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "value")
    out = evaluation.adjacent_outliers(e, "user_id", "event_id", "value", 10.0)
    return out.select("user_id", "pairs", NINE(F.col("rate"), "rate"))


def argmax_prob(spark, d):
    v = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return v.select("vec_id", vec.argmax(F.col("v")).alias("cls"), F.array_max("v").alias("conf"))


XYWH = f"with {BOXES}, s as (select image_id, idx, x1 * 1024 - 200 x, y1 * 1024 - 100 y, (x2 - x1) * 1024 w, (y2 - y1) * 1024 h from boxes where src = 1)"
HIST = """b as (select unnest(range(256))::int bin), c as (select least(255, greatest(0, floor(o_totalprice * 256 / 524288.0::double)))::int bin, count(*) n from orders group by all),
h as (select bin, coalesce(n, 0)::bigint n from b left join c using (bin))"""


def split_sql(by: str) -> str:
    part = f"partition by {by}" if by else ""
    return f"""with r as (select o_orderkey, o_orderpriority, row_number() over ({part} order by {h32(1, 'o_orderkey')}, o_orderkey) - 1 r, count(*) over ({part}) n from orders)
select o_orderkey, {by + ',' if by else ''} case when r < floor(n * 0.8::double) then 'train' when r < floor(n * 0.8::double) + floor(n * 0.1::double) then 'val' else 'test' end part from r"""


QUERIES = {
    "stride_sample": Query(stride_sample, "select conv_id, turn from (select *, row_number() over (partition by conv_id order by turn) - 1 r from conversations) where r % 3 = 0"),
    "topn_per_class": Query(topn_per_class, "select o_orderkey, o_orderpriority, o_totalprice from (select *, row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey) r from orders) where r <= 20"),
    "hash_sample_per_class": Query(hash_sample_per_class, f"select p_partkey, p_brand from (select *, row_number() over (partition by p_brand order by {h32(3, 'p_partkey')}, p_partkey) r from part) where r <= 5"),
    "lag_pairs": Query(lag_pairs, """select conv_id, turn, before, c "value" from (select conv_id, turn, length(text)::int c, lag(length(text)::int) over w before, row_number() over w r from conversations window w as (partition by conv_id order by turn)) where r > 1"""),
    "merge_remap": Query(merge_remap, f"""with {BOXES} select 'a_' || image_id stem, cls + 5 cls, 'a' "source" from boxes where src = 1 and cls in (0, 1) union all select 'b_' || image_id, 5, 'b' from boxes where src = 2 and cls = 2"""),
    "pool_union": Query(pool_union, """select 'f_' || o_orderkey "name", 'f' "source" from orders where o_orderstatus = 'F' and o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')
union all select 'o_' || o_orderkey, 'o' from orders where o_orderstatus = 'O' and o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'A')"""),
    "quota_fill": Query(
        quota_fill,
        """with free as (select distinct l_orderkey, l_returnflag from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'P')),
r as (select * from free where l_returnflag = 'R' order by l_orderkey limit 100),
a as (select * from free where l_returnflag = 'A' and l_orderkey not in (select l_orderkey from r) order by l_orderkey limit 200),
n as (select * from free where l_returnflag = 'N' and l_orderkey not in (select l_orderkey from r union all select l_orderkey from a) order by l_orderkey limit 50)
select * from r union all select * from a union all select * from n""",
    ),
    "ratio_split": Query(ratio_split, split_sql("")),
    "stratified_split": Query(stratified_split, split_sql("o_orderpriority")),
    "orphan_images": Query(orphan_images, "select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag in ('R', 'A'))"),
    "label_clean": Query(
        label_clean,
        f"""with {BOXES}, c as (select *, (x2 - x1) / (y2 - y1) a, (x1 + x2) / 2 cx, (y1 + y2) / 2 cy from boxes)
select image_id, src, idx, cls from c where case cls when 0 then a between 0.5 and 2 when 1 then a <= 1.5 else a >= 0.75 end and cx >= 0.25 and cx < 0.75 and cy >= 0.25 and cy < 0.7501""",
    ),
    "combos": Query(combos, """select a.r_name || '+' || b.r_name combo, 2 r from region a join region b on a.r_name < b.r_name
union all select a.r_name || '+' || b.r_name || '+' || c.r_name, 3 from region a join region b on a.r_name < b.r_name join region c on b.r_name < c.r_name"""),
    "page_tiles": Query(page_tiles, "select p_partkey, p_brand, r // 12 page, r % 12 slot from (select *, row_number() over (partition by p_brand order by p_partkey) - 1 r from part)"),
    "relabel_verify": Query(relabel_verify, f"with {BOXES} select image_id, idx, cls from boxes b where src = 0 and exists (select 1 from orders where o_orderkey = image_id and (o_custkey % 3)::int = cls)"),
    "augment_fanout": Query(
        augment_fanout,
        f"""with {BOXES}, m as (select *, ({h32(0, 'image_id', 'copy')} % 512 - 256) / 1024.0::double dx from boxes, (select unnest([0, 1, 2]) "copy") where src = 0),
s as (select *, greatest(0.0::double, x1 + dx) nx1, least(1.0::double, x2 + dx) nx2 from m)
select image_id, src, idx, "copy", nx1, nx2 from s where greatest(0.0::double, nx2 - nx1) / (x2 - x1) >= 0.3""",
    ),
    "box_quality_filter": Query(
        box_quality_filter,
        f"""with {BOXES}, s as (select *, x2 - x1 w, y2 - y1 h from boxes) select image_id, src, idx from s where w * h between 0.02 and 0.05 and w <= 0.98 and h <= 0.98
and greatest(w, h) / least(w, h) <= 1.5 and image_id not in (select o_orderkey from orders where o_orderstatus = 'P')""",
    ),
    "yolo_from_xywh_noclip": Query(yolo_noclip, f"{XYWH} select image_id, idx, round((x + w / 2) / 640, 9) cx, round((y + h / 2) / 480, 9) cy, round(w / 640, 9) bw, round(h / 480, 9) bh from s"),
    "yolo_from_xywh_clip": Query(
        yolo_clip,
        f"""{XYWH}, c as (select image_id, idx, greatest(0, x) x1, greatest(0, y) y1, least(640, x + w) x2, least(480, y + h) y2 from s)
select image_id, idx, round((x1 + x2) / 2 / 640, 9) cx, round((y1 + y2) / 2 / 480, 9) cy, round((x2 - x1) / 640, 9) bw, round((y2 - y1) / 480, 9) bh from c where x2 > x1 and y2 > y1""",
    ),
    "yolo_from_xywh_clamp": Query(
        yolo_clamp,
        f"{XYWH} select image_id, idx, round(greatest(0.0::double, least(1.0::double, (x + w / 2) / 640)), 9) cx, round(greatest(0.0::double, least(1.0::double, (y + h / 2) / 480)), 9) cy, round(least(1.0::double, w / 640), 9) bw, round(least(1.0::double, h / 480), 9) bh from s",
    ),
    "pixel_box": Query(
        pixel_boxes,
        f"""with {BOXES}, p as (select image_id, idx, {', '.join(f'least({m}, greatest(0, round_even(({c} * 1.5::double - 0.25::double) * {m}, 0)))::bigint {c}' for c, m in (('x1', 100), ('y1', 80), ('x2', 100), ('y2', 80)))} from boxes where src = 2)
select * from p where x2 > x1 and y2 > y1""",
    ),
    "darknet_parse": Query(
        darknet_parse,
        f"""with {BOXES} select image_id, idx::int line_no, cls class_id, greatest(0.0::double, least(1.0::double, (x1 + x2) / 2)) x_center, greatest(0.0::double, least(1.0::double, (y1 + y2) / 2)) y_center, x2 - x1 width, y2 - y1 height
from boxes where src = 0""",
    ),
    "canonical_class": Query(canonical_class, r"""with n as (select p_partkey, [x for x in string_split('rmb ' || p_partkey || ' ' || p_size, ' ') if x in ('100', '50', '20', '10', '5', '1')] f from part) select p_partkey, f[1] cls from n"""),
    "vlm_json_parse": Query(json_parse, "select event_id, event_type label, 0.1::double x1, round(least(1.0::double, (user_id + 30) / 100.0::double), 9) x2, 1.0::double y2, 1.0::double conf from events"),
    "prop_map_ops": Query(
        prop_map_ops,
        """with k as (select *, (props->>'$.k')::int k from events)
select event_id, case when event_type = 'error' then 1.0::double else least(0.75::double, k / 128.0::double, (event_id % 64) / 64.0::double) end min_conf, case k % 4 when 1 then k when 2 then k % 5 else 0 end "value" from k""",
    ),
    "simcc_decode": Query(
        simcc_decode,
        """with v as (select vec_id, embedding[1:32]::double[] xs, embedding[33:64]::double[] ys from embeddings),
c as (select *, (list_max(xs) + list_max(ys)) * 0.5::double conf from v)
select vec_id, case when conf > 0.25 then (list_position(xs, list_max(xs)) - 1) / 2.0::double else 0.0::double end x, case when conf > 0.25 then (list_position(ys, list_max(ys)) - 1) / 2.0::double else 0.0::double end y,
  case when conf > 0.25 then round(conf, 9) else 0.0::double end conf from c""",
    ),
    "tile_grid": Query(tile_grid, "with p as (select p_partkey, (p_partkey % 640 + 64) // 3 w, ((p_size + 48) // 2)::bigint h from part) select p_partkey, k::int k, (k % 3) * w x, (k // 3) * h y, w, h from p, (select unnest(range(6)) k)"),
    "uniform_timestamps": Query(uniform_timestamps, "with p as (select p_partkey, (p_size % 5 + 1)::int n from part), q as (select p_partkey, n, unnest(range(n)) i from p) select p_partkey, case when n = 1 then 0.0::double else round(i * p_partkey::double / (n - 1), 9) end t from q"),
    "frame_index": Query(frame_index, "with s as (select s_suppkey, unnest(range(s_suppkey % 40 + 1)) i from supplier) select s_suppkey, i frame_idx, (i * 40)::bigint ts_ms from s where i % 2 = 0"),
    "class_counts": Query(class_counts, f"with {BOXES} select src, cls, count(*) n from boxes group by all"),
    "error_rate_rollup": Query(error_rate_rollup, """select quality "class", count(*) n, count(*) filter (quality <> doc_id % 2) errors, round(100 * count(*) filter (quality <> doc_id % 2) / count(*), 9) percent from labels group by rollup (quality)"""),
    "error_histogram": Query(error_histogram, "select split_part(url, ':', 1) kind, count(*) n from pages group by all"),
    "crosstab_cube": Query(crosstab_cube, """select lang a, "source" b, count(*) n from documents where lang is not null and "source" is not null group by cube (lang, "source")"""),
    "vote_weighted": Query(
        vote_weighted,
        """with s as (select user_id, [sum((event_id * 3 + user_id) % 64 / 64.0::double * (event_id % 4 + 1)), sum((event_id * 5 + user_id) % 64 / 64.0::double * (event_id % 4 + 1)), sum((event_id * 7 + user_id) % 64 / 64.0::double * (event_id % 4 + 1))] p,
  sum(event_id % 4 + 1)::double w from events group by user_id) select user_id, (list_position(p, list_max(p)) - 1)::int top, round(list_max(p) / w, 9) share from s""",
    ),
    "topk_accuracy": Query(
        topk_accuracy,
        "select count(*) n, round(avg((len([x for x, i in embedding[1:10] if x > embedding[label + 1] or (x = embedding[label + 1] and i < label + 1)]) < 3)::int), 9) accuracy from embeddings",
    ),
    "hist256": Query(hist256, f"with {HIST} select * from h"),
    "quantile_bin": Query(quantile_bin, f"with {HIST}, s as (select *, sum(n) over (order by bin) u, sum(n) over () t from h) select coalesce(min(bin) filter (u > t * 0.5), max(bin)) bin from s"),
    "reduction_ratio": Query(reduction_ratio, f"with {BOXES}, c as (select image_id, count(*) n from boxes group by all) select count(*) n, count(*) filter (n > 8) kept, round(1 - count(*) filter (n > 8) / count(*), 9) reduction from c"),
    "outlier_rate": Query(
        outlier_rate,
        """with s as (select user_id, abs("value" - lag("value") over (partition by user_id order by event_id)) s from events)
select user_id, count(*) pairs, round(avg((s > 10)::int), 9) rate from s where s is not null group by user_id""",
    ),
    "argmax_prob": Query(argmax_prob, "select vec_id, (list_position(embedding, list_max(embedding)) - 1)::int cls, list_max(embedding)::double conf from embeddings"),
}
