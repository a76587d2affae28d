"""Vectors in array files and files named by rows: round trips, guards, failures that leave nothing."""

from __future__ import annotations

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from annolake.sources import files

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_vectors_come_back(spark, tmp_path):
    v = spark.read.parquet(f"{DATA}/embeddings.parquet").select(F.concat(F.lit("crop "), "vec_id").alias("name"), "embedding").repartition(3)
    files.write_vectors(v, f"{tmp_path}/v")
    back = files.read_vectors(spark, f"{tmp_path}/v", rows_per_partition=50)
    assert back.rdd.getNumPartitions() >= 10
    assert sorted(map(tuple, back.select("name", "embedding").collect())) == sorted(map(tuple, v.collect()))
    assert back.where("name = 'crop 7'").select("name").count() == 1
    own = sorted(p for p in os.listdir(tmp_path / "v") if p.endswith(".npy"))
    assert sum(len(np.load(tmp_path / "v" / p)) for p in own) == v.count() and not [p for p in os.listdir(tmp_path / "v") if p.startswith(".write")]
    assert files.manifest_of(f"{tmp_path}/v")["rows"] == v.count()
    with pytest.raises(Exception, match="overwrite mode"):
        files.write_vectors(v, f"{tmp_path}/v")
    files.write_vectors(v.limit(5), f"{tmp_path}/v", replace=True)
    assert files.read_vectors(spark, f"{tmp_path}/v").count() == 5
    files.write_vectors(v.limit(0), f"{tmp_path}/none")
    assert files.read_vectors(spark, f"{tmp_path}/none").count() == 0
    os.remove(next(tmp_path.glob("v/*.npy")))
    with pytest.raises(Exception, match="its manifest"):
        files.read_vectors(spark, f"{tmp_path}/v").collect()


def test_arrays_that_others_wrote(spark, tmp_path):
    whole = np.arange(40, dtype=np.float64).reshape(10, 4)
    np.save(tmp_path / "e.npy", whole)
    (tmp_path / "e.txt").write_text("\n".join(f"n{k}" for k in range(10)))  # no line break at the end
    got = files.read_vectors(spark, f"{tmp_path}/e.npy", rows_per_partition=3).orderBy("row").collect()
    assert [(r.row, r.name, list(r.embedding)) for r in got] == [(k, f"n{k}", whole[k].tolist()) for k in range(10)]
    np.save(tmp_path / "m.npy", np.array([3, 1, 2]))  # a cluster map
    (tmp_path / "m.txt").write_text("a\nb\nc\n")
    assert [r.embedding for r in files.read_vectors(spark, f"{tmp_path}/m.npy").orderBy("row").collect()] == [[3.0], [1.0], [2.0]]
    (tmp_path / "e.txt").write_text("a\nb\n")
    with pytest.raises(Exception, match="10 rows, .* 2 names"):
        files.read_vectors(spark, f"{tmp_path}/e.npy").collect()
    np.save(tmp_path / "f.npy", np.asfortranarray(whole))
    (tmp_path / "f.txt").write_text("x\n" * 10)
    with pytest.raises(Exception, match="one or two dimensions"):
        files.read_vectors(spark, f"{tmp_path}/f.npy").collect()
    (tmp_path / "t.npy").write_text("not an array at all")
    with pytest.raises(Exception, match="no array file"):
        files.read_vectors(spark, f"{tmp_path}/t.npy").collect()


def test_bad_vectors_leave_nothing(spark, tmp_path):
    bad = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0])], "name string, embedding array<float>")
    for rows in (bad, bad.withColumn("name", F.lit("two\nlines")), bad.withColumn("embedding", F.when(F.col("name") == "a", F.col("embedding")))):
        with pytest.raises(Exception, match="vectors of one length|must be one line"):
            files.write_vectors(rows.coalesce(1), f"{tmp_path}/v")
        assert not os.path.exists(tmp_path / "v") or os.listdir(tmp_path / "v") == []


def tree(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, fs in os.walk(folder) for f in fs)


def test_named_files(spark, tmp_path):
    rows = spark.createDataFrame([(f"{k % 3}/x{k}.txt", f"text é {k}") for k in range(30)], "name string, content string").repartition(4)
    files.write_named(rows, f"{tmp_path}/out")
    assert tree(tmp_path / "out") == sorted([f"{k % 3}/x{k}.txt" for k in range(30)] + [files.MANIFEST])
    assert (tmp_path / "out/1/x4.txt").read_text() == "text é 4"
    assert json.loads((tmp_path / "out" / files.MANIFEST).read_text()) == {"kind": "named files", "owner": "annolake", "files": 30, "rows": 30}
    with pytest.raises(Exception, match="overwrite mode"):
        files.write_named(rows, f"{tmp_path}/out")
    with pytest.raises(Exception, match="no named files of another"):
        files.write_named(rows, f"{tmp_path}/out", owner="another", replace=True)
    files.write_named(rows.limit(2), f"{tmp_path}/out", replace=True)
    assert len(tree(tmp_path / "out")) == 3
    (tmp_path / "foreign").mkdir()
    (tmp_path / "foreign/photo.jpg").write_text("mine")
    with pytest.raises(Exception, match="holds files that are no"):
        files.write_named(rows, f"{tmp_path}/foreign", replace=True)
    assert tree(tmp_path / "foreign") == ["photo.jpg"]


def test_a_task_that_fails_leaves_nothing(spark, tmp_path):
    good = [(f"x{k}.txt", "t") for k in range(20)]
    for bad in ("../up.txt", "/etc/x", "a//b", ".hidden", files.MANIFEST):
        with pytest.raises(Exception, match="not a name below the folder"):
            files.write_named(spark.createDataFrame([*good, (bad, "t")], "name string, content string").repartition(3), f"{tmp_path}/out")
        assert tree(tmp_path) == []
    with pytest.raises(ValueError, match="more than one file"):
        files.write_named(spark.createDataFrame([*good, good[0]], "name string, content string"), f"{tmp_path}/out")
    files.write_named(spark.createDataFrame(good, "name string, content string"), f"{tmp_path}/out")
    with pytest.raises(Exception, match="not a name below"):
        files.write_named(spark.createDataFrame([("new.txt", "t"), ("..", "t")], "name string, content string"), f"{tmp_path}/out", replace=True)
    assert len(tree(tmp_path / "out")) == 21  # what was there stays


def test_a_write_that_is_given_up_while_tasks_go_on_leaves_nothing(tmp_path):
    import threading

    for n in range(40):
        writer = files.NamedFilesWriter({"path": f"{tmp_path}/{n}"}, False, "named files")
        store, folder = files.store_of(writer.path)
        begun = threading.Barrier(4)

        def task(own):
            store.create_dir(own, recursive=False)
            begun.wait()
            with pytest.raises(OSError):
                for k in range(1_000_000):
                    store.open_output_stream(f"{own}/x{k}.txt").close()

        tasks = [threading.Thread(target=task, args=(f"{folder}/{writer.staging}/{k}",)) for k in range(3)]
        for t in tasks:
            t.start()
        begun.wait()
        writer.abort([])
        for t in tasks:
            t.join()
        assert os.listdir(writer.path) == []
