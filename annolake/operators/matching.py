"""Matching of boxes between sources, consensus among sources, and scoring of their disputes.

Boxes are rows (image_id, src, idx, cls, x1, y1, x2, y2, conf). Joins are on the image first, so boxes of different
images never meet. Pairs are joins and higher-order functions; the walk over seeds, whose steps depend on each other,
goes through batches of whole images as arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annolake.functions.geometry import corners, iou


def iou_pairs(boxes: DataFrame, src_a: int, src_b: int, least: float) -> DataFrame:
    """(image_id, ia, ib, cls_a, cls_b, iou): all pairs of two sources' boxes at ``least`` or more."""
    side = lambda src, s: boxes.where(F.col("src") == src).select("image_id", *[F.col(c).alias(f"{s}{c}") for c in ("idx", "cls", "x1", "y1", "x2", "y2")])
    pairs = side(src_a, "a_").join(side(src_b, "b_"), "image_id").withColumn("iou", iou(corners("a_"), corners("b_")))
    return pairs.where(F.col("iou") >= least).select("image_id", F.col("a_idx").alias("ia"), F.col("b_idx").alias("ib"), F.col("a_cls").alias("cls_a"), F.col("b_cls").alias("cls_b"), "iou")


def greedy_match(pairs: DataFrame, key: str = "image_id", *, larger_on_ties: bool = True) -> DataFrame:
    """One-to-one (key, ia, ib, iou): pairs of the highest iou first, each index used once.

    Equal ious: the larger indices first, or the smaller ones where ``larger_on_ties`` is off.
    """
    sign = 1 if larger_on_ties else -1
    item = F.struct(F.col("iou").alias("s"), (sign * F.col("ia")).alias("a"), (sign * F.col("ib")).alias("b"))
    ordered = pairs.groupBy(key).agg(F.sort_array(F.collect_list(item), asc=False).alias("c"))
    none = F.slice("c", 1, 0)
    used = lambda acc, x: F.exists(acc, lambda y: (y["a"] == x["a"]) | (y["b"] == x["b"]))
    kept = F.aggregate("c", none, lambda acc, x: F.when(used(acc, x), acc).otherwise(F.concat(acc, F.array(x))))
    flat = ordered.select(key, F.explode(kept).alias("m"))
    return flat.select(key, (sign * F.col("m.a")).alias("ia"), (sign * F.col("m.b")).alias("ib"), F.col("m.s").alias("iou"))


def same_everywhere(boxes: DataFrame, src_a: int, src_b: int, least: float) -> DataFrame:
    """(image_id, same): as many boxes from both sources, and every box of ``src_a`` near some box of ``src_b``."""
    count = lambda s: F.count_if(F.col("src") == s)
    sizes = boxes.groupBy("image_id").agg(count(src_a).alias("na"), count(src_b).alias("nb"))
    met = iou_pairs(boxes, src_a, src_b, least).groupBy("image_id").agg(F.count_distinct("ia").alias("met"))
    joined = sizes.where("na > 0 or nb > 0").join(met, "image_id", "left")
    return joined.select("image_id", ((F.col("na") == F.col("nb")) & (F.coalesce("met", F.lit(0)) == F.col("na"))).alias("same"))


def null_aware_join(boxes: DataFrame, coverage: DataFrame) -> DataFrame:
    """(image_id, sources, n_boxes): images for which every source ran; a source that ran and found nothing has 0.

    A source that failed for an image leaves the image out; it is never taken as having found nothing.
    """
    found = boxes.groupBy("image_id", "src").agg(F.count("*").alias("n"))
    joined = coverage.join(found, ["image_id", "src"], "left").withColumn("n", F.when(F.col("ok"), F.coalesce("n", F.lit(0))))
    whole = joined.groupBy("image_id").agg(F.count("*").alias("sources"), F.count("n").alias("ran"), F.sum("n").alias("n_boxes"))
    return whole.where("ran = sources").select("image_id", "sources", "n_boxes")


def votes(boxes: DataFrame, target: int, weights: dict[int, float], least: float, agree: int) -> DataFrame:
    """(image_id, idx, n_votes, fp): sources with a box near each target box, and its share of the doubt below ``agree``."""
    others = boxes.where(F.col("src").isin(*weights))
    pairs = boxes.where(F.col("src") == target).select("image_id", "idx", *[F.col(c).alias(f"t_{c}") for c in ("x1", "y1", "x2", "y2")])
    near = pairs.join(others.drop("idx"), "image_id").where(iou(corners("t_"), corners()) >= least).select("image_id", "idx", "src").distinct()
    weight = F.element_at(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]), F.col("src"))
    voted = near.groupBy("image_id", "idx").agg(F.count("*").alias("n_votes"), F.sum(weight).alias("w"))
    whole = sum(weights.values()) or 1.0
    doubt = (F.lit(whole) - F.coalesce("w", F.lit(0.0))) / whole
    out = pairs.select("image_id", "idx").join(voted, ["image_id", "idx"], "left").withColumn("n_votes", F.coalesce("n_votes", F.lit(0).cast("long")))
    return out.select("image_id", "idx", "n_votes", F.when(F.col("n_votes") < agree, doubt).otherwise(F.lit(0.0)).alias("fp"))


PAIRS = 2_000_000  # pairs of boxes that a task compares at once


def _alike(left: np.ndarray, right: np.ndarray, start: np.ndarray, end: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, iou) of the corners of one side and those from ``start`` to ``end`` of the other that are ``least`` or more alike.

    However many boxes an image has, PAIRS of them, or those of one box, are held at once.
    """
    total = np.r_[0, np.cumsum(end - start)]
    i = 0
    while i < len(left):
        k = max(i + 1, int(np.searchsorted(total, total[i] + PAIRS, "right")) - 1)
        a = np.repeat(np.arange(i, k), (end - start)[i:k])
        b = np.arange(total[i], total[k]) - total[a] + start[a]
        x, y = left[a], right[b]
        sides = np.maximum(0.0, np.minimum(x[:, 2:], y[:, 2:]) - np.maximum(x[:, :2], y[:, :2]))
        shared = sides[:, 0] * sides[:, 1]
        union = (x[:, 2] - x[:, 0]) * (x[:, 3] - x[:, 1]) + (y[:, 2] - y[:, 0]) * (y[:, 3] - y[:, 1]) - shared
        v = np.divide(shared, union, out=np.zeros_like(shared), where=union > 0)
        keep = v >= least
        yield a[keep], b[keep], v[keep]
        i = k


def _groups(owner: np.ndarray, src: np.ndarray, idx: np.ndarray, corners: np.ndarray, sources: int, least: float, agree: int) -> tuple[np.ndarray, np.ndarray]:
    """(members, group of each): boxes on which ``agree`` sources or more agree, each group's seed first.

    Boxes come by image and, in it, in the order of seeds; ``src`` is a source's place among the ``sources``. All images
    of a batch take their next seed together.
    """
    after = np.arange(1, len(owner) + 1)
    found = [(a[m], b[m], v[m]) for a, b, v in _alike(corners, corners, after, np.searchsorted(owner, owner, "right"), least) for m in [src[a] != src[b]]]
    a, b, v = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    a, b, v = np.r_[a, b], np.r_[b, a], np.r_[v, v]
    order = np.lexsort((-idx[b], -v, a))
    a, b = a[order], b[order]
    first = np.searchsorted(a, np.arange(len(owner) + 1))
    rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
    turns = np.argsort(rank, kind="stable")
    edges = np.r_[0, np.cumsum(np.bincount(rank))] if len(rank) else np.zeros(1, int)
    used, members, groups = np.zeros(len(owner), bool), [], []
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        seeds = turns[lo:hi]
        seeds = seeds[~used[seeds]]
        sizes = first[seeds + 1] - first[seeds]
        nth = np.repeat(np.arange(len(seeds)), sizes)
        near = b[np.arange(len(nth)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[seeds][nth]]
        free = ~used[near]
        nth, near = nth[free], near[free]
        _, nearest = np.unique(nth * sources + src[near], return_index=True)
        nth, near = nth[nearest], near[nearest]
        used[seeds], used[near] = True, True
        enough = 1 + np.bincount(nth, minlength=len(seeds)) >= agree
        of = np.r_[np.flatnonzero(enough), nth[enough[nth]]]
        box = np.r_[seeds[enough], near[enough[nth]]]
        by_group = np.argsort(of, kind="stable")
        members.append(box[by_group])
        groups.append(seeds[of[by_group]])
    none = np.zeros(0, int)
    return np.concatenate(members or [none]), np.concatenate(groups or [none])


def _in_turn(boxes: DataFrame, sources: list[int]) -> DataFrame:
    """(image_id, nth, src, idx, corners) of the sources' boxes, image by image in the order of seeds."""
    rows = boxes.where(F.col("src").isin(*sources)).withColumns({"src": F.col("src").cast("int"), "idx": F.col("idx").cast("long")})
    turn = W.partitionBy("image_id").orderBy(F.desc_nulls_first("conf"), "src", "idx")
    return rows.select("image_id", F.row_number().over(turn).alias("nth"), "src", "idx", *CORNERS)


def _whole_images(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(ids of images, place of its image for each box, src, idx, corners) of rows of _in_turn; an image may go on in the next batch."""
    held = []

    def arrays() -> tuple:
        rows = pa.Table.from_batches(held).combine_chunks()
        first = rows.column("nth").to_numpy() == 1
        src, idx, *sides = (rows.column(c).to_numpy() for c in ("src", "idx", *CORNERS))
        return rows.column("image_id").combine_chunks().take(pa.array(np.flatnonzero(first))), np.cumsum(first) - 1, src, idx, np.stack(sides, axis=1)

    for rows in batches:
        starts = np.flatnonzero(rows.column("nth").to_numpy() == 1)
        if held and len(starts):
            held.append(rows.slice(0, starts[-1]))
            yield arrays()
            held, rows = [], rows.slice(starts[-1])
        held.append(rows)
    if sum(x.num_rows for x in held):
        yield arrays()


def _places(src: np.ndarray, sources: list[int]) -> np.ndarray:
    """The place of each source among ``sources``, -1 for others."""
    out = np.full(len(src), -1)
    for k, x in enumerate(sources):
        out[src == x] = k
    return out


def consensus(boxes: DataFrame, sources: list[int], least: float, agree: int) -> DataFrame:
    """(image_id, seed_src, seed_idx, supporters): positions on which ``agree`` sources or more have a box.

    Seeds come by falling confidence (then source, idx). Each other source supports a seed with its nearest box not yet
    used (the later of equals); a seed's supporters are used up even where they are too few. supporters: array of
    (src, idx), the seed first. The boxes of an image are brought together once; no pairs of boxes are rows.
    """
    held = _in_turn(boxes, sources)
    kind = held.schema["image_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, owner, src, idx, corners in _whole_images(batches):
            members, groups = _groups(owner, _places(src, sources), idx, corners, len(sources), least, agree)
            starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(groups) else np.zeros(0, int)
            tags = pa.StructArray.from_arrays([pa.array(src[members], pa.int32()), pa.array(idx[members], pa.int64())], ["src", "idx"])
            lists = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(members)], pa.int32()), tags)
            seeds = groups[starts]
            columns = [ids.take(pa.array(owner[seeds])), pa.array(src[seeds], pa.int32()), pa.array(idx[seeds], pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, ["image_id", "seed_src", "seed_idx", "supporters"])

    return held.mapInArrow(run, f"image_id {kind}, seed_src int, seed_idx long, supporters array<struct<src:int,idx:bigint>>")


def dispute_scores(boxes: DataFrame, coverage: DataFrame, target: int, weights: dict[int, float], least: float, agree: int) -> DataFrame:
    """(image_id, score, n_fp, n_fn) for images that every source covers: doubted target boxes plus missed consensus.

    The boxes of an image are brought together once; votes, consensus and what it lacks are found from that one row.
    """
    sources, whole = list(weights), sum(weights.values()) or 1.0
    weight = np.array([weights[x] for x in sources], float)
    images = coverage.groupBy("image_id").agg(F.count("*").alias("sources"), F.count_if("ok").alias("ran")).where("ran = sources").select("image_id")
    held = _in_turn(boxes, sorted({target, *sources}))
    kind = held.schema["image_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, image, src, idx, corners in _whole_images(batches):
            n, place, aim = len(ids), _places(src, sources), src == target
            mine, targets, own = image[aim], corners[aim], place >= 0
            owner, place, idx, corners = image[own], place[own], idx[own], corners[own]
            voted, covered = np.zeros((len(mine), len(sources)), bool), np.zeros(len(owner), bool)
            for t, b, _ in _alike(targets, corners, np.searchsorted(owner, mine), np.searchsorted(owner, mine, "right"), least):
                voted[t, place[b]], covered[b] = True, True
            doubted = voted.sum(axis=1) < agree
            fp = np.bincount(mine[doubted], ((whole - voted @ weight) / whole)[doubted], n)
            members, groups = _groups(owner, place, idx, corners, len(sources), least, agree)
            missed = ~covered[groups]
            fn = np.bincount(owner[groups[missed]], weight[place[members[missed]]] / whole, n)
            n_fn = np.bincount(owner[groups[missed & (members == groups)]], minlength=n)
            columns = [ids, pa.array(fp + fn, pa.float64()), pa.array(np.bincount(mine[doubted], minlength=n), pa.int64()), pa.array(n_fn, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["image_id", "score", "n_fp", "n_fn"])

    scored = held.mapInArrow(run, f"image_id {kind}, score double, n_fp long, n_fn long")
    return images.join(scored, "image_id", "left").na.fill(0)


def sample_class(boxes: DataFrame, target: int, reference: int, least: float) -> DataFrame:
    """(image_id, kind): drop_empty, negative, positive or drop_agree by how a target's boxes match the reference's."""
    count = lambda s: F.count_if(F.col("src") == s)
    sizes = boxes.groupBy("image_id").agg(count(target).alias("nt"), count(reference).alias("nr"))
    matched = greedy_match(iou_pairs(boxes, target, reference, least)).groupBy("image_id").agg(F.count("*").alias("m"))
    m = F.coalesce("m", F.lit(0))
    kind = (
        F.when((F.col("nt") == 0) & (F.col("nr") == 0), "drop_empty")
        .when(F.col("nr") == 0, "negative")
        .when(F.col("nt") == 0, "positive")
        .when((m == F.col("nt")) & (m == F.col("nr")), "drop_agree")
        .otherwise("positive")
    )
    return sizes.join(matched, "image_id", "left").select("image_id", kind.alias("kind"))


CORNERS = ("x1", "y1", "x2", "y2")
RANGES = 1024  # ranges of scores to each power of two


def review_set(scored: DataFrame, ratio: float, key: str = "image_id", least: float | None = None) -> DataFrame:
    """``scored`` with ``route``: l0 without doubt, review for the top ``ratio`` of doubtful rows, l1 for the others.

    With ``least``, review is for scores of that much and more, whatever their number. Otherwise the cut is found from
    counts over ranges of scores (RANGES to each power of two), then from the distinct scores of the one range in which
    it falls, and only rows of the score at the cut are put in order, by key: no window holds all rows or all scores.
    """
    doubtful = F.col("score") > 0
    if least is not None:
        return scored.withColumn("route", F.when(~doubtful, "l0").when(F.col("score") >= least, "review").otherwise("l1"))
    span = F.when(doubtful, F.floor(F.log2("score") * RANGES))
    rows = scored.withColumn("_span", span)
    above = W.orderBy(F.desc("_span")).rowsBetween(W.unboundedPreceding, -1)
    spans = rows.where("_span is not null").groupBy("_span").agg(F.count("*").alias("_n"))
    want = F.floor(F.sum("_n").over(W.partitionBy(F.lit(1))) * ratio)
    spans = spans.select("_span", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_before"), "_n", want.alias("_want"))
    edge = spans.where("_before < _want and _before + _n > _want").select("_span", "_before", "_want")
    scores = rows.join(edge, "_span").groupBy("_span", "score").agg(F.count("*").alias("_n"), F.first("_before").alias("_start"), F.first("_want").alias("_want"))
    higher = W.partitionBy("_span").orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, -1)
    scores = scores.select("score", (F.col("_start") + F.coalesce(F.sum("_n").over(higher), F.lit(0))).alias("_first"), F.col("_n").alias("_same"), F.col("_want").alias("_most"))
    placed = rows.join(spans.select("_span", "_before", "_want"), "_span", "left").join(scores, "score", "left")
    # rows of other scores are dealt over parts, where their order does not count
    cut = (F.col("_first") < F.col("_most")) & (F.col("_first") + F.col("_same") > F.col("_most"))
    part = F.when(cut, -1).otherwise(F.pmod(F.xxhash64(key), F.lit(4096)))
    nth = F.row_number().over(W.partitionBy("score", part).orderBy(key))
    inside = F.when(F.col("_first").isNull(), F.col("_before") < F.col("_want")).when(cut, F.col("_first") + nth <= F.col("_most")).otherwise(F.col("_first") < F.col("_most"))
    route = F.when(~doubtful, "l0").when(inside, "review").otherwise("l1")
    return placed.withColumn("route", route).select(*scored.columns, "route")
