"""Queries over vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from annolake.operators import outliers, similarity
from annolake.plans.fixtures import VECTORS, table, vectors
from annolake.plans.query import Query
from annolake.plans.storage import kept

LEAST = 0.4
def cosine_pairs(spark, d):
    return similarity.similar_pairs(vectors(spark, d), LEAST).select("a", "b", (F.round("sim", 6) + 0.0).alias("sim"))


def knn_topk(spark, d):
    v = vectors(spark, d)
    out = similarity.nearest(v.where("vec_id % 100 = 0"), v, 10)
    return out.select("query", "rank", "id", (F.round("sim", 6) + 0.0).alias("sim"))


def near_dup_components(spark, d):
    return similarity.components(similarity.similar_pairs(vectors(spark, d), LEAST), kept)


def near_dup_reps(spark, d):
    roots = near_dup_components(spark, d)
    gone = roots.where("node <> root").select(F.col("node").alias("vec_id"))
    return table(spark, d, "embeddings").select("vec_id").join(gone, "vec_id", "left_anti")


def image_embedding(spark, d):
    out = similarity.mean_vector(vectors(spark, d), "image_id", 64)
    return out.select("image_id", "n", (F.round(F.col("mean")[0], 6) + 0.0).alias("m0"), (F.round(F.col("mean")[63], 6) + 0.0).alias("m63"))


def _marks(spark, d):
    return similarity.fingerprints(vectors(spark, d).where("vec_id % 7 <> 0"), "image_id", "label")


def fingerprint_dedup_keep(spark, d):
    return similarity.first_of_each(_marks(spark, d), "image_id", table(spark, d, "orders").selectExpr("o_orderkey as image_id"))


def fingerprint_dedup_drop(spark, d):
    return similarity.first_of_each(_marks(spark, d), "image_id")


def nearest_to_centroid(spark, d):
    v = vectors(spark, d)
    centres = v.groupBy("label").agg(F.array(*[F.round(F.avg(F.col("v")[k]), 9) for k in range(64)]).alias("centre"))
    return similarity.nearest_to_centre(v, centres, "label")


def sim_matrix_int(spark, d):
    return similarity.pairwise_percent(vectors(spark, d), "image_id")


def coreset(spark, d):
    return similarity.core_set(vectors(spark, d), 50)


def outlier_scores(spark, d):
    return outliers.outliers(vectors(spark, d), kept, trees=200, contamination=0.02)


def weighted_dbscan(spark, d):
    v = vectors(spark, d)
    items = v.selectExpr("vec_id as id", "0.25D + (vec_id % 4) / 4D as weight")
    return similarity.density_clusters(items, similarity.similar_pairs(v, 0.35), 1.5, kept)


DOT = "round(list_sum(list_transform(range(1, 65), lambda i: a.v[i] * b.v[i])), 9)"
EDGES = f"edges as (select a.vec_id a, b.vec_id b from vectors a join vectors b on a.vec_id < b.vec_id where {DOT} >= {{0}})"
REACH = """both_ways as (select a, b from edges union all select b, a from edges),
reach as (select distinct a node, a r from both_ways union select reach.node, both_ways.b from reach join both_ways on reach.r = both_ways.a),
roots as (select node, min(r) root from reach group by node)"""
MARKS = "marks as (select image_id, string_agg(label::varchar, ',' order by label) f from (select distinct image_id, label from vectors where vec_id % 7 <> 0) group by all), firsts as (select min(image_id) image_id from marks group by f)"

QUERIES = {
    "cosine_pairs": Query(cosine_pairs, f"with {VECTORS} select a.vec_id a, b.vec_id b, round({DOT}, 6) sim from vectors a join vectors b on a.vec_id < b.vec_id where {DOT} >= {LEAST}"),
    "knn_topk": Query(
        knn_topk,
        f"""with {VECTORS}, s as (select a.vec_id query, b.vec_id id, {DOT} sim from vectors a, vectors b where a.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query order by sim desc, id) "rank" from s) select query, "rank"::int "rank", id, round(sim, 6) sim from r where "rank" <= 10""",
    ),
    "near_dup_components": Query(near_dup_components, f"with recursive {VECTORS}, {EDGES.format(LEAST)}, {REACH} select * from roots"),
    "near_dup_reps": Query(near_dup_reps, f"with recursive {VECTORS}, {EDGES.format(LEAST)}, {REACH} select vec_id from vectors left join roots on node = vec_id where coalesce(root, vec_id) = vec_id"),
    "image_embedding": Query(
        image_embedding,
        f"""with {VECTORS}, m as (select image_id, count(*) n, list_transform(range(1, 65), lambda k: 0.0) z, [{', '.join(f'avg(v[{k}])' for k in range(1, 65))}] m from vectors group by image_id)
select image_id, n, round(m[1] / sqrt(list_sum(list_transform(m, lambda x: x * x))), 6) m0, round(m[64] / sqrt(list_sum(list_transform(m, lambda x: x * x))), 6) m63 from m""",
    ),
    "fingerprint_dedup_keep": Query(fingerprint_dedup_keep, f"with {VECTORS}, {MARKS} select image_id from firsts union all select o_orderkey from orders where o_orderkey not in (select image_id from marks)"),
    "fingerprint_dedup_drop": Query(fingerprint_dedup_drop, f"with {VECTORS}, {MARKS} select image_id from firsts"),
    "nearest_to_centroid": Query(
        nearest_to_centroid,
        f"""with {VECTORS}, c as (select label, [{', '.join(f'round(avg(v[{k}]), 9)' for k in range(1, 65))}] v from vectors group by label),
d as (select a.label, a.vec_id, round(list_sum(list_transform(range(1, 65), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i]))), 9) far from vectors a join c b on a.label = b.label)
select label, arg_min(vec_id, (far, vec_id)) vec_id from d group by label""",
    ),
    "sim_matrix_int": Query(sim_matrix_int, f"with {VECTORS} select a.image_id, a.vec_id a, b.vec_id b, trunc({DOT} * 100)::int percent from vectors a join vectors b on a.image_id = b.image_id and a.vec_id < b.vec_id"),
    "coreset": Query(coreset),
    "outlier_scores": Query(outlier_scores),
    "weighted_dbscan": Query(
        weighted_dbscan,
        f"""with recursive {VECTORS}, {EDGES.format(0.35).replace('edges as', 'near as')},
nb as (select a, b from near union all select b, a from near union all select vec_id, vec_id from vectors),
core as (select a from nb join vectors on b = vec_id group by a having sum(0.25::double + (b % 4) / 4.0::double) >= 1.5),
edges as (select a, b from nb where a in (select a from core) and b in (select a from core)), {REACH}
select a id, min(root) cluster from nb join roots on node = b group by a""",
    ),
}
