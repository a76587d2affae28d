"""Queries of label sets, names and frames, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from annolake.functions import geometry as geo
from annolake.operators import labelsets, sampling
from annolake.plans.curation import h32
from annolake.plans.fixtures import BOXES, boxes, table
from annolake.plans.query import Query

FORMATS = {"odd": r"/\d*[13579]\.x$", "long": r"/\d{3,}\.x$", "five": r"5\.x$"}


def _least(spark, d, src):
    return boxes(spark, d).where(F.col("src") == src).groupBy("image_id").agg(F.min("conf").alias("min_conf"))


def _records(which):
    def run(spark, d):
        images = table(spark, d, "orders").select(F.col("o_orderkey").alias("image_id"))
        return labelsets.label_records(images, _least(spark, d, 1).where("image_id % 3 <> 0"), _least(spark, d, 2), "image_id", which, 0.5)

    return run


def meta_values(spark, d):
    p = table(spark, d, "part").select(F.col("p_brand").alias("meta"), (F.col("p_partkey") % 7).alias("position"), "p_size")
    p = p.groupBy("meta", "position").agg(F.array_sort(F.collect_set("p_size")).alias("values"))
    p = p.withColumn("name", F.when(F.col("position").isin(1, 4), "common").otherwise(F.concat(F.lit("p"), F.col("position").cast("string"))))
    return labelsets.inherited(p, "meta", "position").select("meta", "position", "name", F.concat_ws(",", F.transform("values", lambda v: v.cast("string"))).alias("values"))


def settled_labels(spark, d):
    b = boxes(spark, d).where("src = 3").withColumn("name", F.when((F.col("cls") == 2) & (F.col("conf") > 0.5), "pending").otherwise("note"))
    x, y, w, h = F.col("x1") * 640 - 64, F.col("y1") * 480 - 48, (F.col("x2") - F.col("x1")) * 640, (F.col("y2") - F.col("y1")) * 480
    box = geo.yolo_plain(x, y, w, h, F.lit(640.0), F.lit(480.0))
    return labelsets.settled(b, "image_id").select("image_id", "idx", (F.col("cls") - 1).alias("cat"), ((x >= 0) & (y >= 0)).alias("held"), *[c.alias(n) for c, n in zip(box, ("cx", "cy", "w", "h"), strict=True)])


def set_format(spark, d):
    p = table(spark, d, "part").select(F.col("p_brand").alias("folder"), F.concat(F.lit("s/"), F.col("p_partkey").cast("string"), F.lit(".x")).alias("path")).where("p_brand <> 'Brand#11' or path rlike '[02468].x$'")
    return labelsets.format_of(p, "folder", "path", FORMATS)


def path_rules(spark, d):
    p = table(spark, d, "part")
    path = F.concat(F.lit("root/"), F.col("p_size").cast("string"), F.lit("/"), F.col("p_brand"), F.lit("_"), F.col("p_partkey").cast("string"), F.lit(".jpg"))
    return p.select("p_partkey", labelsets.label_path(path, "hop", 7).alias("label"), labelsets.class_of_folder(path).alias("cls"))


def triplets(spark, d):
    b = boxes(spark, d)
    one = lambda k, n: b.where(F.col("src") == k).select(F.concat_ws("_", F.col("image_id").cast("string"), F.col("idx").cast("string")).alias("stem"), F.col("cls").alias(n))
    return one(1, "a").join(one(2, "b"), "stem").join(one(3, "label"), "stem")


def crop_plan(spark, d):
    b = boxes(spark, d).where("src = 1 and cls <> 0").withColumn("value", F.col("idx") % 3 - 1)
    return labelsets.crop_names(b, "image_id", "idx", "value", "v_").select("image_id", "idx", "path")


def pool_names(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("stem"))
    labelled = table(spark, d, "supplier").select(F.when(F.col("s_suppkey") % 2 == 0, "a").otherwise("b").alias("source"), F.col("s_suppkey").alias("stem"))
    return labelsets.pool_links({"a": p, "b": p.where("stem % 3 <> 0")}, labelled, "stem")


def time_stride(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") % 400).alias("frames"), (F.col("s_nationkey") * 1.5).alias("fps"))
    return s.select("s_suppkey", F.explode(labelsets.kept_frames(F.col("frames"), F.col("fps"), 0.5, 12)).alias("frame"))


def strip_grid(spark, d):
    p = table(spark, d, "part").select("p_partkey", (F.col("p_size") * 10 + 320).alias("w"), (F.col("p_size") * 3 + 240).alias("h"))
    return p.select("p_partkey", F.inline(labelsets.strips(F.col("w"), F.col("h"), 128, 96, 4)))


def half_pictures(spark, d):
    p = table(spark, d, "part").select("p_partkey", (F.col("p_size") * 17 + 100).alias("w"), (F.col("p_partkey") % 50 * 17 + 100).cast("int").alias("h"))
    return p.select("p_partkey", F.inline(labelsets.halves(F.col("w"), F.col("h"))))


def others(spark, d):
    pool = table(spark, d, "supplier").select("s_suppkey")
    return sampling.others_drawn(table(spark, d, "part").select("p_partkey"), pool, "p_partkey", "s_suppkey", 3, seed=5)


def others_again(spark, d):
    pool = table(spark, d, "supplier").select("s_suppkey")
    return sampling.others_drawn(table(spark, d, "part").select("p_partkey"), pool, "p_partkey", "s_suppkey", 3, seed=6, replace=True)


def drawn_pairs(spark, d):
    e = table(spark, d, "embeddings")
    return sampling.pairs_drawn(e.select("vec_id"), e, "vec_id", "vec_id", "label", seed=9).withColumnRenamed("vec_id", "idx")


def name_rules(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name", F.concat_ws("_", "p_name", F.when(F.col("p_partkey") % 4 > 0, F.col("p_partkey").cast("string")).otherwise("x")).alias("stem"))
    sequence, frame = labelsets.sequence_frame(F.col("stem"))
    crop = labelsets.crop_source(F.concat("p_name", F.when(F.col("p_partkey") % 3 > 0, F.lit("_p")).otherwise("_q"), F.col("p_partkey").cast("string"), F.lit(".jpg")))
    return p.select("p_partkey", sequence.alias("sequence"), frame.alias("frame"), crop.alias("source"), labelsets.safe_name(F.concat(F.lit("~ "), "p_name", F.lit(" 钱!"))).alias("safe"))


def class_lists(spark, d):
    text = F.expr("case p_partkey % 5 when 0 then ' ' when 1 then '2, 0,2' when 2 then '7' when 3 then '1,x' else '1,,' end")
    return table(spark, d, "part").select("p_partkey", F.concat_ws(",", F.transform(labelsets.class_list(text, [0, 1, 2]), lambda v: v.cast("string"))).alias("classes"))


def field_checks(spark, d):
    wrong = labelsets.wrong_fields({"o_orderstatus": ["F", "O"], "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]})
    return table(spark, d, "orders").select("o_orderkey", F.concat_ws(",", wrong).alias("wrong"))


def overlay_looks(spark, d):
    p = table(spark, d, "part")
    t, value = F.col("p_partkey") / 8, F.col("p_size").cast("double")
    return p.select("p_partkey", F.round(labelsets.hue(F.col("p_partkey")), 6).alias("hue"), labelsets.blinks(t, 0.5, 0.25).alias("shown"), F.round(labelsets.light_factor(value, F.lit(25.0)), 9).alias("factor"))


def dated(spark, d):
    o = table(spark, d, "orders").where(F.col("o_orderdate") >= F.lit("1996-01-01").cast("date"))
    return o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"))


def labelme(spark, d):
    whole = lambda c, n: (F.col(c) * n).cast("long")
    x1, y1, x2, y2 = whole("x1", 1024), whole("y1", 1024), whole("x2", 1024), whole("y2", 1024)
    points = F.array(F.array(x1, y1), F.array(x2, y1), F.array(x2, y2), F.array(x1, y2))
    shape = F.struct(F.concat(F.lit("c"), F.col("cls").cast("string")).alias("label"), points.alias("points"), F.lit("polygon").alias("shape_type"))
    rows = boxes(spark, d).where("src = 0").groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("idx", shape.alias("shape")))).alias("s"))
    out = F.struct(F.lit("4.5.6").alias("version"), F.transform("s", lambda s: s["shape"]).alias("shapes"), F.concat(F.col("image_id").cast("string"), F.lit(".jpg")).alias("imagePath"), F.lit(1024).alias("imageHeight"), F.lit(1024).alias("imageWidth"))
    return rows.select("image_id", F.to_json(out).alias("text"))


def _records_sql(there):
    return f"""with {BOXES}, own as (select image_id, min(conf) c from boxes where src = 1 and image_id % 3 <> 0 group by 1), imported as (select image_id, min(conf) c from boxes where src = 2 group by 1)
select o_orderkey image_id, case when a.c is not null then 'own' when b.c is not null then 'imported' else 'none' end origin, coalesce(a.c, b.c, 1.0::double) min_conf
from orders left join own a on a.image_id = o_orderkey left join imported b on b.image_id = o_orderkey where {there} and coalesce(a.c, b.c, 1.0::double) <= 0.5"""


QUERIES = {
    "label_records_all": Query(_records("all"), _records_sql("true")),
    "label_records_export": Query(_records("export"), _records_sql("b.c is not null")),
    "label_records_labeled": Query(_records("labeled"), _records_sql("a.c is not null")),
    "meta_values": Query(
        meta_values,
        """with p as (select p_brand meta, p_partkey % 7 position, list_sort(list(distinct p_size)) v from part group by 1, 2),
c as (select a.*, (select b.v from p b where b.meta = a.meta and b.position in (1, 4) and b.position < a.position order by b.position desc limit 1) s from p a)
select meta, position, case when position in (1, 4) then 'common' else 'p' || position end "name",
  array_to_string(case when position in (1, 4) or s is null then v else list_concat(s, v) end, ',') "values" from c""",
    ),
    "settled_labels": Query(
        settled_labels,
        f"""with {BOXES}, b as (select *, cls = 2 and conf > 0.5 p, x1 * 640 - 64 x, y1 * 480 - 48 y, (x2 - x1) * 640 bw, (y2 - y1) * 480 bh from boxes where src = 3)
select image_id, idx, cls - 1 cat, x >= 0 and y >= 0 held, (x + bw / 2) / 640 cx, (y + bh / 2) / 480 cy, bw / 640 w, bh / 480 h
from b where image_id not in (select image_id from b where p)""",
    ),
    "set_format": Query(
        set_format,
        r"""with p as (select p_brand folder, 's/' || p_partkey || '.x' path from part where p_brand <> 'Brand#11' or p_partkey % 2 = 0)
select folder, case when bool_or(regexp_matches(path, '5\.x$')) then 'five' when bool_or(regexp_matches(path, '/\d{3,}\.x$')) then 'long' when bool_or(regexp_matches(path, '/\d*[13579]\.x$')) then 'odd' end "format" from p group by folder""",
    ),
    "path_rules": Query(path_rules, "select p_partkey, 'root/hop_m7/' || p_brand || '_' || p_partkey || '.json' \"label\", p_size cls from part"),
    "triplets": Query(
        triplets,
        f"""with {BOXES} select a.image_id || '_' || a.idx stem, a.cls a, b.cls b, c.cls "label" from boxes a join boxes b using (image_id, idx) join boxes c using (image_id, idx) where a.src = 1 and b.src = 2 and c.src = 3""",
    ),
    "crop_plan": Query(
        crop_plan,
        f"""with {BOXES} select image_id, idx, (idx % 3 - 1) || '/v_' || image_id || '_' || lpad((row_number() over (partition by image_id order by idx))::varchar, 4, '0') || '.jpg' path
from boxes where src = 1 and cls <> 0 and idx % 3 >= 1""",
    ),
    "pool_names": Query(
        pool_names,
        """with p as (select 'a' source, p_partkey stem from part union all select 'b', p_partkey from part where p_partkey % 3 <> 0)
select source, stem, source || '_' || stem || '.jpg' image, source || '_' || stem || '.txt' "label" from p
where exists (select 1 from supplier where s_suppkey = stem and case when s_suppkey % 2 = 0 then 'a' else 'b' end = source)""",
    ),
    "time_stride": Query(
        time_stride,
        """with s as (select s_suppkey, s_suppkey % 400 frames, greatest(1, round_even(case when s_nationkey > 0 then s_nationkey * 1.5::double else 25 end * 0.5::double, 0)::int) step from supplier),
f as (select s_suppkey, step, unnest(range(least(12, ceil(frames / step))::bigint)) k from s)
select s_suppkey, (k * step)::int frame from f""",
    ),
    "strip_grid": Query(
        strip_grid,
        """with p as (select p_partkey, p_size * 10 + 320 pw, p_size * 3 + 240 ph, unnest([0, 1, 2, 3]) k from part) select p_partkey, k * ((pw - 128) // 3) x, ph - 96 y, 128 w, 96 h from p""",
    ),
    "half_pictures": Query(
        half_pictures,
        """with p as (select p_partkey, p_size * 17 + 100 w, p_partkey % 50 * 17 + 100 h from part),
q as (select *, greatest(w, h) / least(w, h) > 1.6 cut, floor((w // 2) * 0.1::double)::bigint ow, floor((h // 2) * 0.1::double)::bigint oh from p)
select p_partkey, 0 x1, 0 y1, case when cut and w >= h then w // 2 + ow else w end x2, case when cut and w < h then h // 2 + oh else h end y2 from q
union all select p_partkey, case when w >= h then w // 2 - ow else 0 end, case when w < h then h // 2 - oh else 0 end, w, h from q where cut""",
    ),
    "others_drawn": Query(
        others,
        f"""with recursive dir as (select s_suppkey, row_number() over (order by {h32(5, 's_suppkey')}, s_suppkey) - 1 r from supplier),
w as (select p_partkey, d.r own, (select count(*) from dir) - (d.r is not null)::int m from part left join dir d on s_suppkey = p_partkey),
walk as (
  select p_partkey, own, m, least(3, m) k, 0::bigint j, []::bigint[] got from w
  union all
  select p_partkey, own, m, k, j + 1, list_append(got, case when list_contains(got, t) then m - k + j else t end)
  from (select *, {h32(5, 'p_partkey', 'j')} % (m - k + j + 1) t from walk where j < k)),
drawn as (select p_partkey, own, unnest(range(k)) draw, unnest(got) t from walk where j = k)
select p_partkey, draw::int draw, s_suppkey from drawn join dir on r = t + coalesce((t >= own)::int, 0)""",
    ),
    "others_drawn_again": Query(
        others_again,
        f"""with dir as (select s_suppkey, row_number() over (order by {h32(6, 's_suppkey')}, s_suppkey) - 1 r from supplier),
w as (select p_partkey, d.r own, (select count(*) from dir) - (d.r is not null)::int m, unnest([0, 1, 2]) j from part left join dir d on s_suppkey = p_partkey),
drawn as (select p_partkey, own, j, {h32(6, 'p_partkey', 'j')} % m t from w where m > 0)
select p_partkey, j draw, s_suppkey from drawn join dir on r = t + coalesce((t >= own)::int, 0)""",
    ),
    "drawn_pairs": Query(
        drawn_pairs,
        f"""with m as (select label, vec_id, row_number() over (partition by label order by {h32(9, 'vec_id')}, vec_id) - 1 r, count(*) over (partition by label) n from embeddings),
g as (select label, n, row_number() over (order by {h32(9, 'label')}, label) - 1 place from (select distinct label, n from m)),
c as (select count(*) groups from g),
x as (select vec_id idx, {h32(9, 'vec_id', "'group'")} % groups at_a, {h32(9, 'vec_id', "'other'")} % greatest(groups - 1, 1) o,
  {h32(9, 'vec_id', "'first'")} ha, {h32(9, 'vec_id', "'second'")} hb from embeddings, c),
y as (select idx, at_a, ha, hb, case when idx % 2 = 0 then at_a else o + (o >= at_a)::int end at_b from x),
z as (select idx, a.label la, b.label lb, ha % a.n ra, case when idx % 2 = 0 then hb % greatest(b.n - 1, 1) else hb % b.n end t, b.n - (idx % 2 = 0)::int has
  from y join g a on a.place = at_a join g b on b.place = at_b)
select idx, p.vec_id "first", q.vec_id "second", (idx % 2 = 0)::int alike from z join m p on p.label = la and p.r = ra
join m q on q.label = lb and q.r = case when idx % 2 = 0 then t + (t >= ra)::int else t end where has > 0""",
    ),
    "name_rules": Query(
        name_rules,
        """select p_partkey, case when p_partkey % 4 > 0 then p_name end "sequence", case when p_partkey % 4 > 0 then p_partkey end frame, case when p_partkey % 3 > 0 then p_name end source,
  regexp_replace(p_name, '[^0-9A-Za-z]+', '_', 'g') || '_钱' safe from part""",
    ),
    "class_lists": Query(class_lists, "select p_partkey, case p_partkey % 5 when 0 then '0,1,2' when 1 then '0,2' when 4 then '1' else '' end classes from part"),
    "field_checks": Query(
        field_checks,
        """select o_orderkey, concat_ws(',', case when o_orderstatus in ('F', 'O') then null else 'o_orderstatus' end,
  case when o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM') then null else 'o_orderpriority' end) wrong from orders""",
    ),
    "overlay_looks": Query(
        overlay_looks,
        """select p_partkey, round((p_partkey * 0.61803398875::double) % 1, 6) hue, (p_partkey / 8) % 0.75::double < 0.5 shown,
  round(greatest(0.7::double, least(1.3::double, 25.0::double / (p_size + 0.001::double))), 9) factor from part""",
    ),
    "dated": Query(dated, "select o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') iso from orders where o_orderdate >= date '1996-01-01'"),
    "labelme": Query(
        labelme,
        f"""with {BOXES}, b as (select image_id, idx, cls, (x1 * 1024)::bigint a, (y1 * 1024)::bigint t, (x2 * 1024)::bigint r, (y2 * 1024)::bigint e from boxes where src = 0)
select image_id, json_object('version', '4.5.6', 'shapes', list({{'label': 'c' || cls, 'points': [[a, t], [r, t], [r, e], [a, e]], 'shape_type': 'polygon'}} order by idx),
  'imagePath', image_id || '.jpg', 'imageHeight', 1024, 'imageWidth', 1024)::varchar "text" from b group by image_id""",
    ),
}
