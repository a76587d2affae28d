"""Benchmark decontamination by winnowing.

A window is ``width`` consecutive words of a benchmark item; an item of fewer words is one window. Of the hashes of all
k-grams in a window the least is its fingerprint, k = (width + 1) // 2, so equal windows have equal fingerprints and
every shared span of ``width`` words or more has at least one on both sides: nothing that long is missed. Shorter items
have windows of their own width, and so fingerprints of their own.

Fingerprints of all windows of the training texts are formed where the texts are read and held against a bitmap of the
benchmark's, whose size is bounded whatever the benchmark's. A fingerprint that may be shared is extended to the windows
that chose it; these go on as (fingerprint, words) and are joined with the benchmark's windows by both, so a hit is
settled word by word, and a k-gram that stands in many windows of both sides makes no pairs. What leaves the scan is
one row for each distinct window of a document that passes the bitmap. The benchmark's windows are broadcast if they
are counted to be few, otherwise both sides are shuffled, the documents' side over salts.

Rows count one by one: repeated rows each get their result. Null and empty texts have no words and are never
contaminated; null ids are kept as they are. A null or empty item has no window; items of one id are one item. Extra
columns are ignored, whatever their names. Empty tables give empty results, an empty benchmark clean documents.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolake.llm.common import stored
from annolake.llm.words import Words, blocks, gram_hashes

WIDTH = 10
BLOCK = 1 << 22  # bytes of text whose words are hashed together
BITMAP_BITS = 1 << 27  # at most; 16 MB
FEW_WINDOWS = 200_000  # up to so many windows of the benchmark are broadcast, about 20 MB
SALTS = 16

_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)


def gram_size(width: int) -> int:
    return (width + 1) // 2


def fingerprints(words: Words, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, fingerprint) of every window of ``width`` words that lies in one row."""
    k = gram_size(width)
    grams = gram_hashes(hashes, k)
    n = max(len(hashes) - width + 1, 0)
    least = grams[:n].copy()
    for j in range(1, width - k + 1):
        np.minimum(least, grams[j : j + n], out=least)
    row = words.rows()
    at = np.flatnonzero(row[:n] == row[width - 1 :][:n])
    return at, least[at]


_window = "item string, width int, print long, words binary"


def windows_of(items: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(item, width, print, words): all windows of all items."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, _, words in blocks(batch.column(1), BLOCK):
                hashes, counts = words.hashes(), words.counts
                for size in np.unique(np.minimum(counts[counts > 0], width)).tolist():
                    at, prints = fingerprints(words, hashes, size)
                    rows = words.rows()[at]
                    own = np.minimum(counts[rows], width) == size
                    at, prints, rows = at[own], prints[own], rows[own]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([ids[first + r] for r in rows.tolist()], pa.string()),
                            pa.array(np.full(len(at), size, np.int32)),
                            pa.array(prints.view(np.int64)),
                            pa.array([words.text(a, a + size) for a in at.tolist()], pa.binary()),
                        ],
                        ["item", "width", "print", "words"],
                    )

    return items.select(F.col(id_col).cast("string"), F.col(text_col)).mapInArrow(run, _window)


def _places(prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return (prints & np.uint64(bits - 1)).astype(np.int64), ((prints * _SECOND) >> np.uint64(64 - (bits.bit_length() - 1))).astype(np.int64)


def bitmap_of(prints: DataFrame, n: int) -> np.ndarray:
    """Two bits for each of the ``n`` values of the column ``print``, in 64 to 128 bits for each, BITMAP_BITS at most."""
    bits = min(1 << max(20, (64 * n).bit_length()), BITMAP_BITS)

    def run(batches):
        for batch in batches:
            both = np.unique(np.concatenate(_places(batch.column(0).to_numpy().view(np.uint64), bits)))
            yield pa.RecordBatch.from_arrays([pa.array(both >> 6), pa.array((np.uint64(1) << (both & 63).astype(np.uint64)).view(np.int64))], ["at", "bit"])

    set_words = prints.select("print").mapInArrow(run, "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits >> 6, np.int64)
    out[set_words.column("at").to_numpy()] = set_words.column("bits").to_numpy()
    return out.view(np.uint8)  # bit b is bit b % 8 of byte b // 8, as words are little-endian


def _in_bitmap(bitmap: np.ndarray, prints: np.ndarray) -> np.ndarray:
    a, b = _places(prints, 8 * len(bitmap))
    found = (bitmap[a >> 3] >> (a & 7).astype(np.uint8)) & 1 == 1
    at = np.flatnonzero(found)
    found[at] = (bitmap[b[at] >> 3] >> (b[at] & 7).astype(np.uint8)) & 1 == 1
    return found


_hit = "array<struct<width int, print long, words binary, starts array<int>>>"


def scanned(docs: DataFrame, bitmap: np.ndarray, widths: list[int], id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, hits): for each row the distinct windows whose fingerprint may be the benchmark's, and where they start."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    spark_hit = pa.list_(pa.struct([("width", pa.int32()), ("print", pa.int64()), ("words", pa.binary()), ("starts", pa.list_(pa.int32()))]))

    def run(batches):
        for batch in batches:
            for first, end, words in blocks(batch.column(1), BLOCK):
                hashes, found = words.hashes(), defaultdict(dict)
                for width in widths:
                    at, prints = fingerprints(words, hashes, width)
                    keep = _in_bitmap(shared.value, prints)
                    at, prints = at[keep], prints[keep].view(np.int64)
                    rows = np.searchsorted(words.first, at, side="right") - 1
                    for row, a, p in zip(rows.tolist(), at.tolist(), prints.tolist(), strict=True):
                        window = (width, p, words.text(a, a + width))
                        found[row].setdefault(window, []).append(a - int(words.first[row]))
                hits = [[{"width": w, "print": p, "words": t, "starts": s} for (w, p, t), s in found[r].items()] if r in found else [] for r in range(end - first)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(words.counts.astype(np.int64)), pa.array(hits, spark_hit)], ["id", "n_words", "hits"]
                )

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, n_words long, hits {_hit}")


def contaminated(
    docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH
) -> DataFrame:
    """(id, n_words, n_hit, items, spans) for every row of ``docs``.

    n_hit: words inside any occurrence of a window. items: the ids, as sorted strings, of the items with such windows.
    spans: (start, stop) in words, maximal and in order.
    """
    windows = stored(windows_of(items, item_col, item_text_col, width).where("item is not null").distinct(), "windows")
    by_window = windows.groupBy("width", "print", "words").agg(F.array_sort(F.collect_set("item")).alias("items"))
    by_window = stored(by_window, "windows")
    n, widths = by_window.agg(F.count("*"), F.collect_set("width")).first()
    rows = scanned(docs, bitmap_of(by_window, n), sorted(widths), id_col, text_col)
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "scanned")

    hits = rows.where(F.size("hits") > 0).select("row", F.explode("hits").alias("hit")).select("row", "hit.*")
    if n <= FEW_WINDOWS:
        hits = hits.join(F.broadcast(by_window), ["width", "print", "words"])
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        hits = hits.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(by_window.withColumn("salt", salts), ["salt", "width", "print", "words"])
    covers = F.transform("starts", lambda s: F.struct(s.alias("start"), (s + F.col("width")).alias("stop")))
    of_row = hits.groupBy("row").agg(F.flatten(F.collect_list(covers)).alias("covers"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))

    def grown(s, c):
        """Spans that are closed, and the one that is open: a cover beyond its end closes it."""
        apart = c["start"] > s["open"]["stop"]
        longer = F.struct(s["open"]["start"].alias("start"), F.greatest(s["open"]["stop"], c["stop"]).alias("stop"))
        return F.struct(F.when(apart, F.concat(s["closed"], F.array(s["open"]))).otherwise(s["closed"]).alias("closed"), F.when(apart, c).otherwise(longer).alias("open"))

    none = F.array().cast("array<struct<start int, stop int>>")
    covers = F.array_sort("covers")
    spans = F.aggregate(covers, F.struct(none.alias("closed"), covers[0].alias("open")), grown, lambda s: F.concat(s["closed"], F.array(s["open"])))
    out = rows.select("row", "id", "n_words").join(of_row.select("row", "items", spans.alias("spans")), "row", "left")
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return out.select(
        "id", "n_words", F.coalesce(size, F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("spans", none).alias("spans")
    )
