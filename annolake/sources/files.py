"""Data sources for files whose names and layout are given: vectors with their names, and one file for each row.

Paths are opened with Arrow's file systems, so they may lie in any store that these reach, as long as driver and
executors reach it alike. A write puts everything below a folder of its own inside the target; committing moves it out
and leaves a manifest, aborting removes it, so a task or a job that fails halfway leaves nothing. A folder that holds
anything that this library did not write is never written to.
"""

from __future__ import annotations

import ast
import json
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

MANIFEST, STAGING = "_manifest.json", ".write-"
BATCH = 4096  # rows of an Arrow batch


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _entries(store: fs.FileSystem, folder: str) -> list[str]:
    return [f.base_name for f in store.get_file_info(fs.FileSelector(folder, allow_not_found=True))]


def manifest_of(path: str) -> dict | None:
    store, folder = store_of(path)
    if store.get_file_info(f"{folder}/{MANIFEST}").type != fs.FileType.File:
        return None
    with store.open_input_stream(f"{folder}/{MANIFEST}") as f:
        return json.loads(f.read())


@dataclass
class Written(WriterCommitMessage):
    folder: str
    files: int
    rows: int


class FolderWrite:
    """What both writers share: the staging folder, moving out of it, the manifest, and whose a folder is."""

    def __init__(self, options: dict, overwrite: bool, kind: str):
        self.path, self.kind, self.owner = options["path"], kind, options.get("owner", "annolake")
        store, folder = store_of(self.path)
        found = [n for n in _entries(store, folder) if not n.startswith(STAGING)]
        if found:
            known = manifest_of(self.path)
            if known is None or known.get("kind") != kind or known.get("owner") != self.owner:
                raise ValueError(f"{self.path} holds files that are no {kind} of {self.owner}")
            if not overwrite:
                raise ValueError(f"{self.path} holds {kind} of {self.owner} already: write in overwrite mode to replace them")
        self.replaced = found
        self.staging = f"{STAGING}{uuid.uuid4().hex}"
        store.create_dir(f"{folder}/{self.staging}", recursive=True)

    def task_folder(self) -> str:
        """A folder for this attempt; an attempt that goes on after the job was given up finds none to put it in."""
        from pyspark import TaskContext

        task, (store, folder) = TaskContext.get(), store_of(self.path)
        own = f"{self.staging}/{task.partitionId()}-{task.taskAttemptId()}"
        store.create_dir(f"{folder}/{own}", recursive=False)
        return own

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = store_of(self.path)
        done = [m for m in messages if m is not None]
        for name in self.replaced:
            store.delete_dir(f"{folder}/{name}") if store.get_file_info(f"{folder}/{name}").type == fs.FileType.Directory else store.delete_file(f"{folder}/{name}")

        def move(message: Written) -> None:
            own = f"{folder}/{message.folder}"
            for f in store.get_file_info(fs.FileSelector(own, recursive=True, allow_not_found=True)):
                if f.type == fs.FileType.File:
                    to = folder + f.path[f.path.index(message.folder) + len(message.folder) :]
                    store.create_dir(to.rsplit("/", 1)[0], recursive=True)
                    store.move(f.path, to)

        with ThreadPoolExecutor(16) as pool:
            list(pool.map(move, done))
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{folder}/{MANIFEST}") as f:
            f.write(json.dumps({"kind": self.kind, "owner": self.owner, "files": sum(m.files for m in done), "rows": sum(m.rows for m in done)}).encode())
        self.abort([])

    def abort(self, messages: list) -> None:
        """The folder goes under another name first: tasks that still run would put files into it while it is deleted, which then fails."""
        store, folder = store_of(self.path)
        own = f"{folder}/{self.staging}"
        if store.get_file_info(own).type == fs.FileType.Directory:
            try:
                store.move(own, gone := f"{own}-gone")
            except (OSError, NotImplementedError):  # a store of objects moves no folders
                gone = own
            store.delete_dir(gone)


class NamedFilesWriter(FolderWrite, DataSourceWriter):
    def write(self, iterator: Iterator) -> Written:
        store, folder = store_of(self.path)
        own, made, n = self.task_folder(), set(), 0
        for row in iterator:
            parts = row["name"].split("/")
            if row["name"].startswith(("/", "_", ".")) or ".." in parts or "" in parts:
                raise ValueError(f"not a name below the folder: {row['name']!r}")
            to = f"{folder}/{own}/{row['name']}"
            for depth in range(1, len(parts)):
                if (parent := "/".join(parts[:depth])) not in made:
                    store.create_dir(f"{folder}/{own}/{parent}", recursive=False)
                    made.add(parent)
            with store.open_output_stream(to) as f:
                f.write(row["content"].encode() if isinstance(row["content"], str) else bytes(row["content"] or b""))
            n += 1
        return Written(own, n, n)


class NamedFiles(DataSource):
    """Writes (name, content), one file for each row."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "name string, content string"

    def writer(self, schema, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesWriter(self.options, overwrite, "named files")


def write_named(files: DataFrame, path: str, *, owner: str = "annolake", replace: bool = False) -> None:
    """One file for each (name, content) below ``path``; two rows of one name are an error before anything is written."""
    files.sparkSession.dataSource.register(NamedFiles)
    twice = files.groupBy("name").count().where("count > 1 or name is null").limit(1).collect()
    if twice:
        raise ValueError(f"more than one file, or none, is named {twice[0]['name']!r}")
    files.select("name", "content").write.format("named_files").option("owner", owner).mode("overwrite" if replace else "append").save(path)


def header_of(store: fs.FileSystem, path: str) -> tuple[np.dtype, tuple[int, ...], int]:
    """(kind, shape, where the rows begin) of an array file."""
    with store.open_input_file(path) as f:
        start = f.read(12)
        if start[:6] != b"\x93NUMPY":
            raise ValueError(f"{path} is no array file")
        skip = 10 if start[6] == 1 else 12
        size = int.from_bytes(start[8:skip], "little")
        f.seek(skip)
        about = ast.literal_eval(f.read(size).decode("latin1"))
    if about["fortran_order"] or len(about["shape"]) not in (1, 2):
        raise ValueError(f"{path}: rows of an array of one or two dimensions are read")
    return np.dtype(about["descr"]), about["shape"], skip + size


@dataclass
class Rows(InputPartition):
    array: str
    names: str
    first: int
    end: int
    names_at: int


class ArrayReader(DataSourceReader):
    """Partitions are ranges of rows; each opens the array at its first row and the names at its first line."""

    def __init__(self, options: dict):
        self.path, self.rows = options["path"], int(options.get("rowsPerPartition", 1 << 18))

    def files(self) -> list[tuple[str, str]]:
        store, path = store_of(self.path)
        if store.get_file_info(path).type == fs.FileType.Directory:
            own = sorted(n for n in _entries(store, path) if n.endswith(".npy"))
            return [(f"{path}/{n}", f"{path}/{n[:-4]}.txt") for n in own]
        return [(path, path.removesuffix(".npy") + ".txt")]

    def partitions(self) -> list[Rows]:
        store, _ = store_of(self.path)
        out, total = [], 0
        for array, names in self.files():
            _, shape, _ = header_of(store, array)
            starts, n, at = [], 0, 0
            with store.open_input_stream(names) as f:  # where every rowsPerPartition-th line begins, without holding them
                rest = b""
                while block := f.read(1 << 22):
                    lines = (rest + block).split(b"\n")
                    rest = lines.pop()
                    for line in lines:
                        if n % self.rows == 0:
                            starts.append(at)
                        n, at = n + 1, at + len(line) + 1
                if rest:
                    starts += [at] if n % self.rows == 0 else []
                    n += 1
            if n != shape[0]:
                raise ValueError(f"{array} has {shape[0]} rows, {names} {n} names")
            out += [Rows(array, names, k * self.rows, min(n, (k + 1) * self.rows), start) for k, start in enumerate(starts)]
            total += n
        known = manifest_of(self.path) if out or total == 0 else None
        if known is not None and known["rows"] != total:
            raise ValueError(f"{self.path} has {total} rows, its manifest {known['rows']}")
        return out or [Rows("", "", 0, 0, 0)]

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        if partition.first == partition.end:
            return
        store, _ = store_of(self.path)
        kind, shape, begin = header_of(store, partition.array)
        width = shape[1] if len(shape) == 2 else 1
        with store.open_input_file(partition.array) as f, store.open_input_file(partition.names) as g:
            f.seek(begin + partition.first * width * kind.itemsize)
            g.seek(partition.names_at)
            rest, lines = b"", []
            for first in range(partition.first, partition.end, BATCH):
                n = min(BATCH, partition.end - first)
                while len(lines) < n:
                    block = g.read(1 << 20)
                    parts = (rest + block).split(b"\n")
                    rest = parts.pop()
                    lines += parts
                    if not block:
                        lines.append(rest)
                        rest = b""
                own, lines = lines[:n], lines[n:]
                values = np.frombuffer(f.read(n * width * kind.itemsize), kind).astype(np.float32)
                edges = pa.array(np.arange(0, n * width + 1, width, dtype=np.int32))
                vectors = pa.ListArray.from_arrays(edges, pa.array(values))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(first, first + n)), pa.array([x.rstrip(b"\r").decode() for x in own]), vectors], ["row", "name", "embedding"])


class ArrayWriter(FolderWrite, DataSourceArrowWriter):
    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written | None:
        from pyspark import TaskContext

        store, folder = store_of(self.path)
        own, stem, n, width = self.task_folder(), f"part-{TaskContext.get().partitionId():05d}", 0, None
        space = 118  # a header of 128 bytes holds any number of rows, so it is written when they are counted
        with store.open_output_stream(f"{folder}/{own}/{stem}.rows") as rows, store.open_output_stream(f"{folder}/{own}/{stem}.txt") as names:
            for batch in iterator:
                for name in batch.column("name").to_pylist():
                    if name is None or "\n" in name or "\r" in name:
                        raise ValueError(f"a name must be one line: {name!r}")
                    names.write(name.encode() + b"\n")
                vectors = batch.column("embedding")
                sizes = set(pc.list_value_length(vectors).to_pylist()) | ({width} if width is not None else set())
                flat = vectors.flatten()
                if batch.num_rows and (len(sizes) != 1 or None in sizes or flat.null_count):
                    raise ValueError("vectors of one length, without nulls, are written")
                width = sizes.pop() if sizes else width
                rows.write(np.ascontiguousarray(flat.to_numpy(zero_copy_only=False), np.float32).tobytes())
                n += batch.num_rows
        if n:
            about = f"{{'descr': '<f4', 'fortran_order': False, 'shape': ({n}, {width}), }}".ljust(space - 1) + "\n"
            with store.open_output_stream(f"{folder}/{own}/{stem}.npy") as out, store.open_input_stream(f"{folder}/{own}/{stem}.rows") as rows:
                out.write(b"\x93NUMPY\x01\x00" + space.to_bytes(2, "little") + about.encode())
                while block := rows.read(1 << 24):
                    out.write(block)
        else:
            store.delete_file(f"{folder}/{own}/{stem}.txt")
        store.delete_file(f"{folder}/{own}/{stem}.rows")
        return Written(own, 2 if n else 0, n)


class ArrayFiles(DataSource):
    """(row, name, embedding) of an array file and the text file of its names beside it, or of a folder of such pairs."""

    @classmethod
    def name(cls) -> str:
        return "array_files"

    def schema(self) -> str:
        return "row long, name string, embedding array<float>"

    def reader(self, schema) -> ArrayReader:
        return ArrayReader(self.options)

    def writer(self, schema, overwrite: bool) -> ArrayWriter:
        return ArrayWriter(self.options, overwrite, "array files")


def read_vectors(spark: SparkSession, path: str, rows_per_partition: int = 1 << 18) -> DataFrame:
    """(row, name, embedding); a number of names other than that of the rows, or of the manifest, is an error."""
    spark.dataSource.register(ArrayFiles)
    return spark.read.format("array_files").option("rowsPerPartition", rows_per_partition).load(path)


def write_vectors(vectors: DataFrame, path: str, *, owner: str = "annolake", replace: bool = False) -> None:
    """(name, embedding) as pairs of an array file and its names, one pair for each partition with rows."""
    vectors.sparkSession.dataSource.register(ArrayFiles)
    rows = vectors.select(F.lit(None).cast("long").alias("row"), F.col("name").cast("string"), F.col("embedding").cast("array<float>"))
    rows.write.format("array_files").option("owner", owner).mode("overwrite" if replace else "append").save(path)
