"""Annotation tables derived from the driver's tables by one closed formula, in Spark and in SQL.

Coordinates are whole 1024ths, so areas and intersections are exact and both engines agree to the last bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image_id, src, idx, cls, x1, y1, x2, y2, conf) of four sources, 0 being the target.

    Lines are dealt by order and sorted once, before they become boxes; what groups by image needs no further shuffle.
    """
    order = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    first = F.row_number().over(W.partitionBy(*order[:2]).orderBy(*order[2:]))
    lines = table(spark, sf_dir, "lineitem").select(*order).repartition("l_orderkey").select("*", first.alias("rn")).where("rn = 1")
    held = [F.expr(f"(l_partkey + {3 * k}) % 5 <> 0") for k in range(4)]
    earlier = W.partitionBy("l_orderkey").orderBy("l_linenumber").rowsBetween(W.unboundedPreceding, 0)
    places = [F.when(h, F.struct(F.lit(k).alias("src"), (F.count_if(h).over(earlier) - 1).alias("idx"))).alias(f"p{k}") for k, h in enumerate(held)]
    rows = lines.select("*", *places).withColumn("p", F.explode(F.array_compact(F.array("p0", "p1", "p2", "p3"))))
    rows = rows.select("*", "p.src", "p.idx").selectExpr(
        "l_orderkey as image_id", "src", "idx", "cast(l_partkey % 3 as int) as cls",
        "((l_partkey * 37) % 640 + (l_suppkey + 13 * src) % 33) / 1024D as x1",
        "((l_suppkey * 53 + l_linenumber * 17) % 640 + (l_partkey + 7 * src) % 33) / 1024D as y1",
        "(96 + (cast(l_quantity as bigint) * 5) % 160) / 1024D as w", "(96 + (l_partkey * 11) % 160) / 1024D as h",
        "((l_suppkey * 31 + l_partkey * 17 + 7 * src) % 128) / 128D as conf",
    )
    return rows.select("image_id", "src", "idx", "cls", "x1", "y1", (F.col("x1") + F.col("w")).alias("x2"), (F.col("y1") + F.col("h")).alias("y2"), "conf")


BOXES = """
lines as (select * from (select *, row_number() over (partition by l_orderkey, l_linenumber
  order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) rn from lineitem) where rn = 1),
sized as (
  select l_orderkey image_id, src, l_linenumber ln, (l_partkey % 3)::int cls,
    ((l_partkey * 37) % 640 + (l_suppkey + 13 * src) % 33) / 1024.0::double x1,
    ((l_suppkey * 53 + l_linenumber * 17) % 640 + (l_partkey + 7 * src) % 33) / 1024.0::double y1,
    (96 + (floor(l_quantity)::bigint * 5) % 160) / 1024.0::double w, (96 + (l_partkey * 11) % 160) / 1024.0::double h,
    ((l_suppkey * 31 + l_partkey * 17 + 7 * src) % 128) / 128.0::double conf
  from lines, (select unnest([0, 1, 2, 3]) src) where (l_partkey + 3 * src) % 5 <> 0),
boxes as materialized (
  select image_id, src, row_number() over (partition by image_id, src order by ln) - 1 idx, cls, x1, y1, x1 + w x2, y1 + h y2, conf from sized)"""

IOU = """(case when (a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1)
  - greatest(0.0::double, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0.0::double, least(a.y2, b.y2) - greatest(a.y1, b.y1)) > 0
  then greatest(0.0::double, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0.0::double, least(a.y2, b.y2) - greatest(a.y1, b.y1))
  / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1)
  - greatest(0.0::double, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0.0::double, least(a.y2, b.y2) - greatest(a.y1, b.y1))) else 0.0::double end)"""


def pairs_sql(a: int, b: int, least: float) -> str:
    return f"""
pairs as (
  select a.image_id, a.idx ia, b.idx ib, a.cls cls_a, b.cls cls_b, {IOU} iou
  from boxes a join boxes b on a.image_id = b.image_id and a.src = {a} and b.src = {b} where {IOU} >= {least})"""


GREEDY = """
ordered as (select *, row_number() over (partition by image_id order by iou desc, ia desc, ib desc) k from pairs),
walk as (
  select image_id, k, ia, ib, iou, [ia] ua, [ib] ub, true hit from ordered where k = 1
  union all
  select o.image_id, o.k, o.ia, o.ib, o.iou,
    case when list_contains(g.ua, o.ia) or list_contains(g.ub, o.ib) then g.ua else list_append(g.ua, o.ia) end,
    case when list_contains(g.ua, o.ia) or list_contains(g.ub, o.ib) then g.ub else list_append(g.ub, o.ib) end,
    not (list_contains(g.ua, o.ia) or list_contains(g.ub, o.ib))
  from walk g join ordered o on o.image_id = g.image_id and o.k = g.k + 1),
matched as (select image_id, ia, ib, iou from walk where hit)"""


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image_id, src, ok): where a source failed for an image."""
    images = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("image_id")).distinct()
    every = images.withColumn("src", F.explode(F.array(*[F.lit(k) for k in range(4)])))
    return every.select("image_id", "src", ((F.col("image_id") + F.col("src")) % 97 != 0).alias("ok"))


COVERAGE = """
coverage as (select image_id, src, (image_id + src) % 97 <> 0 ok
  from (select distinct l_orderkey image_id from lineitem), (select unnest([0, 1, 2, 3]) src))"""


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video, frame_idx, ts_ms, det_idx, cls, conf, x, y, width, height, track): events as detections, track a given id."""
    e = table(spark, sf_dir, "events").select("*", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    e = e.selectExpr(
        "user_id % 10 as video", "ms div 3600000 as hour", "ms", "event_id",
        "case event_type when 'click' then 0 when 'view' then 0 when 'purchase' then 1 else 2 end as cls",
        "(event_id % 128) / 128D as conf", "((user_id * 97) % 800 + event_id % 8) / 1024D as x", "((user_id * 61) % 600 + event_id % 5) / 1024D as y",
        "96 / 1024D as width", "192 / 1024D as height", "user_id as track",
    )
    video = W.partitionBy("video")
    frame = F.dense_rank().over(video.orderBy("hour")) - 1
    e = e.select("*", frame.cast("long").alias("frame_idx"))
    own = W.partitionBy("video", "frame_idx")
    det = F.row_number().over(own.orderBy("event_id")) - 1
    return e.select("video", "frame_idx", (F.col("hour") * 3600000).alias("ts_ms"), det.cast("long").alias("det_idx"), "cls", "conf", "x", "y", "width", "height", "track", "event_id", "ms")


DETECTIONS = """
found as (
  select user_id % 10 video, epoch_us(ts) // 3600000000 as hr, epoch_us(ts) // 1000 ms, event_id,
    case event_type when 'click' then 0 when 'view' then 0 when 'purchase' then 1 else 2 end cls,
    (event_id % 128) / 128.0::double conf, ((user_id * 97) % 800 + event_id % 8) / 1024.0::double x, ((user_id * 61) % 600 + event_id % 5) / 1024.0::double y,
    96 / 1024.0::double width, 192 / 1024.0::double height, user_id track
  from events),
framed as (select *, dense_rank() over (partition by video order by hr) - 1 frame_idx from found),
detections as (
  select video, frame_idx, hr * 3600000 ts_ms, row_number() over (partition by video, frame_idx order by event_id) - 1 det_idx,
    cls, conf, x, y, width, height, track, event_id, ms from framed)"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.expr("vec_id div 4").alias("image_id"), "label", F.col("embedding").cast("array<double>").alias("v"))


VECTORS = "vectors as (select vec_id, vec_id // 4 image_id, label, embedding::double[] v from embeddings)"
