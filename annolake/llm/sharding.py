"""Sharding by sampled splitters, in DataFrame operations only.

Records are ordered by a key (hash of the text, then id). Size-weighted samples of keys give quantile boundaries; the
boundaries cut the keys into many more ranges than shards, ranges found overfull are sampled again more densely and
subdivided, and exact sizes of the ranges give every record its place in the whole order. Shards are equal parts of
that order by size. Equal texts stand together; a group of equal texts that is small beside a shard goes to one shard
whole, a larger one is cut where the sizes need it.

Size is the UTF-8 length of the text (null: none) plus 1. Null ids sort first, repeated rows are separate records, an
empty table gives an empty result, extra columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annolake.llm.common import stored

PER_RANGE = 16  # samples drawn for each range wanted
ROWS_PER_RANGE = 250_000
FEWEST, MOST = 64, 1 << 15  # ranges; MOST bounds what the driver and the plan hold


def _splitters(rows: DataFrame, ranges: int, weight: float, seed: int) -> list[tuple[int, int]]:
    """About ``ranges`` quantile keys of a sample in which each row stands with probability size * PER_RANGE / weight."""
    draw = F.pmod(F.xxhash64("k", "id", "tie", F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    sample = rows.where(draw < F.col("size") * (PER_RANGE / weight)).select("k", "id")
    numbered = sample.withColumn("r", F.row_number().over(W.orderBy("k", "id")))  # a bounded sample: PER_RANGE * MOST keys
    cuts = numbered.where(F.col("r") % PER_RANGE == 0).orderBy("r").select("k", "id").collect()
    return [(r.k, r.id) for r in cuts]


def _range_of(splitters: list[tuple[int, int]]) -> Column:
    """Number of splitters at or below (k, id): found among every B-th splitter first, then among the B that follow."""
    if not splitters:
        return F.lit(0)
    block = max(1, math.isqrt(len(splitters)))
    here = F.struct("k", "id")

    def keys(part):
        return F.from_json(F.lit(json.dumps([{"k": k, "id": i} for k, i in part])), "array<struct<k: bigint, id: bigint>>")

    def below(found: Column) -> Column:
        return F.size(F.filter(found, lambda s: s <= here))

    firsts = below(keys(splitters[::block]))
    nested = json.dumps([[{"k": k, "id": i} for k, i in splitters[at : at + block]] for at in range(0, len(splitters), block)])
    blocks = F.from_json(F.lit(nested), "array<array<struct<k: bigint, id: bigint>>>")
    return F.when(firsts == 0, F.lit(0)).otherwise((firsts - 1) * block + below(F.element_at(blocks, F.greatest(firsts, F.lit(1)))))


def sharded(
    docs: DataFrame,
    shards: int = 8,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    whole_groups_under: float = 0.02,
    seed: int = 11,
) -> DataFrame:
    """(id, size, text_crc32, shard, slot) for every row; sizes of shards differ by about ``whole_groups_under`` at most.

    ``whole_groups_under``: groups of equal texts up to this part of a shard are not cut.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("k"),
        ).select("*", F.monotonically_increasing_id().alias("tie"))
        .withColumn("missing", F.col("id").isNull())
        .withColumn("id", F.coalesce("id", F.lit(-(1 << 62)))),
        "keys",
    )
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    if not total.n:
        return rows.select("id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    wanted = min(MOST, max(FEWEST, shards * 8, -(-total.n // ROWS_PER_RANGE)))
    target = total.bytes / wanted
    splitters = sorted(set(_splitters(rows, wanted, target, seed)))
    for again in range(1, 3):
        ranged = rows.withColumn("range", _range_of(splitters))
        sizes = {r.range: r.bytes for r in ranged.groupBy("range").agg(F.sum("size").alias("bytes")).collect()}
        over = [x for x, b in sizes.items() if b > 2 * target]
        if not over or len(splitters) >= 2 * MOST:
            break
        more = _splitters(ranged.where(F.col("range").isin(over)), len(over), target / 4, seed + again)
        finer = sorted(set(splitters) | set(more))
        if finer == splitters:
            break
        splitters = finer

    # a splitter inside a group of equal texts stays only where the group spans several ranges
    heavy = {a for (a, _), (b, _) in zip(splitters, splitters[1:], strict=False) if a == b}
    splitters = sorted({(k, i) if k in heavy else (k, -(1 << 63)) for k, i in splitters})
    ranged = rows.withColumn("range", _range_of(splitters))
    sizes = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # one row for each range
    starts = sizes.select(
        "range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before")
    )
    placed = ranged.join(starts, "range")
    order = W.partitionBy("range").orderBy("k", "id", "tie")
    group = W.partitionBy("range", "k")
    end = F.sum("size").over(order) + F.col("bytes_before")
    placed = placed.select("*", end.alias("end"), (F.row_number().over(order) + F.col("rows_before")).alias("nr"))
    placed = placed.select("*", F.max("end").over(group).alias("group_end"), F.sum("size").over(group).alias("group_size"))
    part = total.bytes / shards
    whole = F.col("group_size") <= part * whole_groups_under
    middle = F.when(whole, F.col("group_end") - F.col("group_size") / 2).otherwise(F.col("end") - F.col("size") / 2)
    shard = F.least(F.floor(middle / F.lit(part)).cast("int"), F.lit(shards - 1))
    numbered = stored(placed.select("id", "missing", "size", "text_crc32", shard.alias("shard"), "nr"), "placed")
    firsts = numbered.groupBy("shard").agg(F.min("nr").alias("first"))
    return numbered.join(firsts, "shard").select(
        F.when(~F.col("missing"), F.col("id")).alias("id"), "size", "text_crc32", "shard", (F.col("nr") - F.col("first")).alias("slot")
    )
