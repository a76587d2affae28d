"""Shared folder, Arrow text access and hashing used by the operators of this subpackage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a local one only for a local master without it."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="annolake-"))
        atexit.register(shutil.rmtree, _own_folder[0], ignore_errors=True)
    return f"file://{_own_folder[0]}"


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends here, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def named(column: str) -> Column:
    """The column of just this name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` in one struct, so that columns of our own beside it clash with none; ``select("x.*")`` gives them back."""
    return F.struct(*[named(c).alias(c) for c in df.columns])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc32_text(column: str) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


def text_buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array (null: empty) and the n + 1 offsets into them, without copying each row."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    raw = array.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``most_bytes`` of text; one longer text makes a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most_bytes, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and xor-shift)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


BASE = 0x9E3779B97F4A7C15
BASES, POWERS = 6, 1 << 20  # bases and powers of each that a worker keeps; runs draw new bases, workers live on
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; kept for the next call of this worker."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        factors = np.full(max(n, 1 << 16), base, np.uint64)
        factors[0] = 1
        have = np.multiply.accumulate(factors)
        if len(have) <= POWERS:
            _powers.pop(base, None)
            while len(_powers) >= BASES:
                del _powers[next(iter(_powers))]
            _powers[base] = have
    return have[:n]


def prefix_hashes(data: np.ndarray, base: int = BASE) -> np.ndarray:
    """Running polynomial hash; ``span_hash`` turns two of its entries into the hash of the bytes between."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(base, len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = BASE) -> np.ndarray:
    """Hash of data[start:end] for each pair; equal bytes get equal hashes wherever they stand. ``base``: that of ``prefix``."""
    inverse = powers(pow(base, -1, 1 << 64), len(prefix))
    return mixed((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))
