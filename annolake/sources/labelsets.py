"""Readers of label sets, by the folders they are kept in, and of their names and meta files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolake.operators.labelsets import class_of_folder, inherited
from annolake.sources.formats import stem

META = "name string, properties array<struct<name: string, values: array<struct<id: int, name: string>>>>"


def label_pairs(spark: SparkSession, folder: str, format_name: str, meta_id: int, schema: str) -> DataFrame:
    """(image, label) of ``folder/format_m1/*.json``, each label by ``schema``; a missing folder is Spark's error."""
    rows = spark.read.schema(schema).option("multiLine", True).json(f"{folder}/{format_name}_m{meta_id}")
    names = [c for c in rows.columns]
    return rows.select(F.concat(F.lit(f"{folder}/image/"), stem(F.col("_metadata.file_path")), F.lit(".jpg")).alias("image"), F.struct(*names).alias("label"))


def todo_labels(spark: SparkSession, folder: str, meta_id: int) -> DataFrame:
    """(path, text) of all files ``*_m1.todo`` at any depth."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*_m{meta_id}.todo").text(folder, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def pictures(spark: SparkSession, folder: str, pattern: str = "*.jpg") -> DataFrame:
    """(path, stem, cls) of all pictures at any depth; ``cls`` is the number of the folder. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return files.select("path", stem(F.col("path")).alias("stem"), class_of_folder(F.col("path")).alias("cls"))


def picture_triplets(spark: SparkSession, folder: str, pattern: str = "*.png") -> DataFrame:
    """(stem, a, b, label): pictures that the folders A, B and label all hold under one name."""
    side = lambda n: pictures(spark, f"{folder}/{n}", pattern).select("stem", F.col("path").alias(n.lower()))
    return side("A").join(side("B"), "stem").join(side("label"), "stem")


def meta(spark: SparkSession, path: str) -> DataFrame:
    """(meta, position, name, values) of meta files, with the values that properties inherit."""
    rows = spark.read.schema(META).option("multiLine", True).json(path)
    return inherited(rows.select(F.col("name").alias("meta"), F.posexplode("properties").alias("position", "p")).select("meta", "position", "p.name", "p.values"), "meta", "position")


def _scalars(line: str) -> list[str]:
    """The words and marks of one line of settings: quoted words whole, marks ``[ ] { } , : -`` by themselves, comments left out."""
    out, at = [], 0
    while at < len(line):
        c = line[at]
        if c == "#" and (at == 0 or line[at - 1] in " \t"):
            break
        if c in "'\"":
            end = at + 1
            while end < len(line) and line[end] != c:
                end += 1
            out.append("=" + line[at + 1 : end])
            at = end + 1
        elif c in "[]{}," or (c in ":-" and (at + 1 == len(line) or line[at + 1] in " \t")):
            out.append(c)
            at += 1
        elif c in " \t":
            at += 1
        else:
            end = at
            while end < len(line) and line[end] not in "[]{},#" and not (line[end] == ":" and (end + 1 == len(line) or line[end + 1] in " \t")):
                end += 1
            out.append("=" + line[at : max(end, at + 1)].rstrip())
            at = max(end, at + 1)
    return out


def names_of_yaml(text: str) -> list[str]:
    """Class names of a settings file: the list, or the values of the map by their numbers, under ``names``; else none.

    Lists and maps may stand in brackets, over several lines too, or one entry a line. Words may be quoted; comments and
    empty lines do not count.
    """
    lines = [(len(x) - len(x.lstrip()), _scalars(x)) for x in text.splitlines()]
    lines = [(deep, marks) for deep, marks in lines if marks]
    start = next((k for k, (deep, marks) in enumerate(lines) if deep == 0 and marks[:2] == ["=names", ":"]), None)
    if start is None:
        return []
    inline = lines[start][1][2:]
    if inline[:1] in (["["], ["{"]):
        marks, closing = [], "]" if inline[0] == "[" else "}"
        for part in [inline[1:], *(m for _, m in lines[start + 1 :])]:
            marks += part
            if closing in part:
                marks = marks[: marks.index(closing)]
                break
        entries, own = [], []
        for mark in [*marks, ","]:
            if mark == ",":
                entries.append(own)
                own = []
            else:
                own.append(mark)
    else:
        entries = []
        for deep, marks in lines[start + 1 :]:
            if deep == 0 and marks[0] != "-":
                break
            entries.append(marks[1:] if marks[0] == "-" else marks)
    words = [[m[1:] for m in e if m.startswith("=")] for e in entries]
    if all(len(w) == 2 and w[0].isdigit() and ":" in e for w, e in zip(words, entries, strict=True) if e):
        return [w[1] for w in sorted((w for w in words if w), key=lambda w: int(w[0]))]
    return [w[0] if len(w) == 1 else w[1] for w in words if w and w[-1]]
