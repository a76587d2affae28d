"""Exact deduplication as a stateful stream: keyed state on disk, without expiry.

Each arriving row is reduced to its digest, its identifier and a locator of its content. A streaming aggregation keyed
by digest keeps, in the RocksDB state store, the stable identifier (the largest id; of repeated rows with that id the
first), the locator of its content and the number of rows: no watermark, so no key is ever dropped, and partial
aggregation before the shuffle makes a digest of a third of all rows one row per task. Hits, digests seen more than
once, are then checked on their full bytes; where two texts share a digest, rows are grouped by the bytes themselves.

Null text counts as empty. Rows with equal id and equal text are repeats of one row: all are reported and counted, one
is kept. Rows with a null id are grouped like any other. An empty table gives an empty result. Extra columns are
ignored, whatever their names; ``without_duplicates`` gives them back as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolake.llm.common import named, shared_path, stored, whole_row

#: State lives in RocksDB on the executors' disks; all stores of an executor share one bound of native memory, and none
#: reserves disk before it has rows (4 MB a partition otherwise).
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


HOT, SALTS = 10_000, 64


def sha256_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def landed(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> tuple[DataFrame, str]:
    """(id, digest, locator, row), what the stream needs of each row, in the shared folder; and where."""
    path = shared_path(docs.sparkSession, "arrivals")
    rows = docs.select(
        named(id_col).cast("long").alias("id"),
        digest(F.coalesce(named(text_col), F.lit(""))).alias("digest"),
        F.input_file_name().alias("locator"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows.write.parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path), path


def stream_state(arrivals: DataFrame, state_folder: str | None = None) -> DataFrame:
    """(digest, keep_id, keep_row, locator, group_size) after all arrivals; ``arrivals`` is a streaming DataFrame.

    With the same ``state_folder``, a later call goes on from the state of the earlier ones.
    """
    spark = arrivals.sparkSession
    folder = state_folder or shared_path(spark, "dedup-state")
    largest = F.max(F.struct("id", (-F.col("row")).alias("back"), "locator"))
    state = arrivals.groupBy("digest").agg(largest.alias("best"), F.count("*").alias("group_size"))
    shape = state.schema

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/updates/epoch={epoch}")

    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        query = (
            state.writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    try:
        updates = spark.read.schema(shape).option("basePath", f"{folder}/updates").parquet(f"{folder}/updates")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        updates = spark.createDataFrame([], shape)  # no arrivals, no update
    last = updates.groupBy("digest").agg(F.max(F.struct("group_size", "best")).alias("x"))
    return last.select(
        "digest",
        F.col("x.best.id").alias("keep_id"),
        (-F.col("x.best.back")).alias("keep_row"),
        F.col("x.best.locator").alias("locator"),
        F.col("x.group_size").alias("group_size"),
    )


def exact_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256_of,
    max_files: int = 1000,
) -> DataFrame:
    """(id, keep_id, group_size, kept, digest, locator) for every row of ``docs``."""
    spark = docs.sparkSession
    rows, path = landed(docs, id_col, text_col, digest)
    arrivals = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max_files).parquet(path)
    state = stored(stream_state(arrivals), "state")

    # digests of more than a ten-thousandth of all rows, fewer than HOT of them: their rows are dealt over SALTS parts
    n_rows = state.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    hot = F.broadcast(state.where(F.col("group_size") > max(SALTS, n_rows / HOT)).select("digest", F.lit(True).alias("hot")))

    def salted(df: DataFrame, salt: Column) -> DataFrame:
        return df.join(hot, "digest", "left").withColumn("salt", F.when(F.col("hot"), salt).otherwise(0)).drop("hot")

    def on_all_salts(df: DataFrame) -> DataFrame:
        salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        return df.join(hot, "digest", "left").withColumn("salt", F.explode(salts)).drop("hot")

    hits = on_all_salts(state.where("group_size > 1").select("digest"))
    text = F.coalesce(named(text_col), F.lit(""))
    content = docs.select(named(id_col).cast("long").alias("id"), digest(text).alias("digest"), text.cast("binary").alias("bytes"))
    bytes_of_hits = salted(content, F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(hits, ["digest", "salt"])
    parts = bytes_of_hits.groupBy("digest", "salt").agg(F.min("bytes").alias("low"), F.max("bytes").alias("high"))
    differing = parts.groupBy("digest").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high")
    shared = stored(differing.select("digest"), "shared-digests")

    known = on_all_salts(state.withColumnRenamed("locator", "keep_locator"))
    out = salted(rows, F.pmod("row", F.lit(SALTS)).cast("int")).join(known, ["digest", "salt"])
    out = out.select("id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "digest", F.col("keep_locator").alias("locator"))
    if shared.isEmpty():
        return out
    # one digest, several texts: these rows are grouped by their bytes
    collided = content.join(shared, "digest").withColumn("row", F.monotonically_increasing_id())
    collided = stored(collided, "collided")
    groups = collided.groupBy("digest", "bytes").agg(F.max(F.struct("id", (-F.col("row")).alias("back"))).alias("best"), F.count("*").alias("group_size"))
    resolved = collided.join(groups, ["digest", "bytes"]).select(
        "id", F.col("best.id").alias("keep_id"), "group_size", (F.col("row") == -F.col("best.back")).alias("kept"), "digest", F.lit(None).cast("string").alias("locator")
    )
    return out.join(shared, "digest", "left_anti").select(*resolved.columns).union(resolved)


def without_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its own columns, one row of each group of equal texts."""
    kept = exact_duplicates(docs, id_col=id_col, text_col=text_col).where("kept").select(F.struct("id", "digest").alias("key"))
    key = F.struct(named(id_col).cast("long").alias("id"), sha256_of(F.coalesce(named(text_col), F.lit(""))).alias("digest"))
    rows = docs.select(whole_row(docs).alias("doc"), key.alias("key"))  # joins match structs of null
    return rows.join(kept, "key", "left_semi").dropDuplicates(["key"]).select("doc.*")
