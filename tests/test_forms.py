"""Forms of labels, results of the older format, affine maps, table functions and injected stages."""

from __future__ import annotations

import json
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolake.functions import affine, tables
from annolake.operators import conversions, exports, stages
from annolake.sources import files


def test_maps_and_their_inverses(spark):
    lit = lambda *v: [F.lit(float(x)) for x in v]
    m = affine.top_down(*lit(50, 40, 80), 192, 256, degrees=30)
    n = affine.affine(*lit(1, 2, 3, -1, 1, 5))
    mx, my = affine.moved(m, *lit(7, 9))
    bx, by = affine.moved(affine.inverse(m), mx, my)
    px, py = affine.moved(affine.product(m, n), *lit(7, 9))
    qx, qy = affine.moved(m, *affine.moved(n, *lit(7, 9)))
    middle = affine.moved(m, *lit(50, 40))
    # the point straight above the middle, in the crop's turned frame, comes straight above the middle of the output
    up = affine.moved(m, F.lit(50 + 40 * math.sin(math.radians(30))), F.lit(40 - 40 * math.cos(math.radians(30))))
    row = spark.range(1).select(bx, by, px - qx, py - qy, *middle, *up).first()
    assert list(row) == pytest.approx([7, 9, 0, 0, 96, 128, 96, 128 - 96])
    assert spark.range(1).select(affine.top_down(*lit(5, 5, 0), 192, 256)).first()[0] == (1, 0, 0, 0, 1, 0)
    assert spark.range(1).select(affine.inverse(affine.affine(*lit(1, 2, 0, 2, 4, 0)))).first()[0] is None
    assert spark.range(1).select(*affine.fitted(*lit(30, 100), 192, 256)).first() == (75, 100)
    assert spark.range(1).select(*affine.fitted(*lit(90, 100), 192, 256)).first() == (90, 120)


def test_results_of_the_older_format(spark, tmp_path):
    folder = tmp_path / "a2d_m4"
    folder.mkdir()
    whole = {"roi": [{"x": 0, "y": 0}], "objects": [{"id": 3, "cls": 1, "conf": 0.5, "rect": {"x": 0.1, "y": 0.2, "width": 0.3, "height": 0.4}, "props": {"2": [0.1, 0.7, 0.7]}}], "more": 1}
    (folder / "a.b.json").write_text(json.dumps(whole, indent=1))
    (folder / "empty.json").write_text('{"objects": []}')
    (folder / "bad.json").write_text("{")
    (folder / "odd.json").write_text('{"objects": [{"id": "x", "rect": 5}]}')
    got = {r.image: r.result for r in conversions.results(spark, str(tmp_path), 4).collect()}
    o = got["a.b"].objects[0]
    assert (o.id, o.cls, o.conf, tuple(o.rect), o.props) == (3, 1, 0.5, (0.1, 0.2, 0.3, 0.4), {"2": [0.1, 0.7, 0.7]})
    assert [tuple(p) for p in got["a.b"].roi] == [(0, 0)] and got["empty"].objects == [] and got["empty"].roi is None
    assert got["bad"].objects is None and got["odd"].objects[0].id is None and got["odd"].objects[0].rect.x is None
    label = conversions.results(spark, str(tmp_path), 4).where("image = 'a.b'").select(F.explode("result.objects").alias("o")).select(conversions.of_result(F.col("o")).alias("l"), conversions.to_darknet(conversions.of_result(F.col("o"))).alias("d")).first()
    assert label.l.properties[2] == (1, 0.7) and label.l.polygon[2].x == pytest.approx(0.4)
    assert tuple(label.d) == pytest.approx((1, 0.25, 0.4, 0.3, 0.4))


def test_names_and_numbers_of_classes(spark):
    rows = spark.createDataFrame([("van", 0.0, 0.0, 2.0, 1.0), ("bus", 0.0, 0.0, 1.0, 1.0)], "cls string, x1 double, y1 double, x2 double, y2 double")
    label = conversions.of_kitti(F.struct("*"), ["car", "van"])
    got = rows.select(label.alias("l"), conversions.to_kitti(label, ["car", "van"]).alias("k")).collect()
    assert [r.l.prob_class.value for r in got] == [1, None] and got[0].l.id == conversions.NO_ID
    assert tuple(got[0].k) == ("van", 0, 0, 2, 1) and got[1].k.cls is None


def test_table_functions(spark):
    tables.register(spark)
    assert [tuple(r) for r in spark.sql("select * from tiles(10, 7, 3, 2)").collect()][:4] == [(0, 0, 0, 3, 3), (1, 3, 0, 3, 3), (2, 6, 0, 3, 3), (3, 0, 3, 3, 3)]
    assert spark.sql("select * from tiles(null, 7, 3, 2)").collect() == []
    assert [r.at for r in spark.sql("select * from times(9D, 4)").collect()] == [0, 3, 6, 9] and spark.sql("select * from times(9D, 1)").first().at == 0
    with pytest.raises(Exception, match="must be positive"):
        spark.sql("select * from times(9D, 0)").collect()
    spark.createDataFrame([("a", 3, "z"), ("a", 1, "x"), ("b", 1, "q"), ("a", 2, None)], "cam string, at int, file string").createOrReplaceTempView("shots")
    got = spark.sql("select * from neighbours(table(shots), 'cam', 'at', 'file')")
    assert got.columns == ["cam", "before", "item"] and sorted(map(tuple, got.collect()), key=str) == [("a", "x", None), ("a", None, "z")]
    with pytest.raises(Exception, match="no column nope"):
        spark.sql("select * from neighbours(table(shots), 'nope', 'at', 'file')").collect()


class Counted:
    made = 0

    def __init__(self):
        Counted.made += 1

    def __call__(self, rows):
        assert len(rows) <= 4
        if any(r["x"] == 13 for r in rows):
            raise RuntimeError("no thirteen")
        return [(r["x"] * 2, Counted.made) for r in rows]


def test_stages(spark):
    rows = spark.createDataFrame([(i, None if i == 5 else i, "y") for i in range(40)], "id long, x long, `a.b` string").repartition(3)
    out = stages.staged(rows, "counted", Counted, ["x"], T.StructType().add("twice", T.LongType()).add("made", T.LongType()), batch=4)
    out, seen = stages.observed(out, "counts")
    got = {r.id: r for r in out.collect()}
    assert len(got) == 40 and got[13].result is None and got[13].error == "RuntimeError: no thirteen"
    assert got[5].result is None and got[5].error is None
    assert all(got[i].result.twice == 2 * i and got[i].result.made == 1 and got[i].error is None for i in range(40) if i not in (5, 13))
    assert seen.get == {"rows": 40, "results": 38, "errors": 1}
    short = stages.staged(rows, "short", lambda: lambda r: r[:-1], ["x"], T.LongType(), batch=2).where("x = 1").first()
    assert short.error == "ValueError: 0 results for 1 rows"
    with pytest.raises(ValueError, match="column error"):
        stages.staged(rows.withColumn("error", F.lit(1)), "s", Counted, ["x"], T.LongType())
    assert stages.staged(rows.where("id < 0"), "none", Counted, ["x"], T.LongType()).collect() == []


def test_exports_to_files(spark, tmp_path):
    images = spark.createDataFrame([("a", 0.5), ("b", 0.0), ("c.d", 0.0)], "image string, x double").withColumns({"y": F.lit(0.0), "w": F.lit(0.5), "h": F.lit(1.0)})
    boxes = spark.createDataFrame([("a", 1, 2, 0.75, 0.5, 0.1, 0.2), ("a", 0, -1, 0.0, 0.0, 0.0, 0.0), ("b", 0, 0, 1 / 3, 0.5, 0.1, 0.2)], "image string, idx int, class_id int, cx double, cy double, w double, h double")
    out = {r.image: r for r in exports.label_files(images, boxes, crop=("x", "y", "w", "h")).collect()}
    assert (out["a"].content, out["a"].n_objects) == ("2 0.500000 0.500000 0.200000 0.200000\n", 2)
    assert (out["c.d"].name, out["c.d"].content, out["c.d"].n_objects) == ("labels/c.d.txt", "", 0)
    plain = {r.image: r.content for r in exports.label_files(images, boxes, line=exports.plain_line).collect()}
    assert plain["b"] == "0 0.3333333333333333 0.5 0.1 0.2\n"
    records = exports.record_files(images, "hop_m3", F.col("image"), F.struct("x", F.lit(None).cast("int").alias("none")))
    report = exports.mining_report(spark.createDataFrame([("l0",), ("review",), ("l1",), ("l1",)], "route string"), images.limit(1), {"iou": 0.5})
    assert tuple(report.first()) == (5, 1, 1, 2, 1, '{"iou":0.5}')
    shape = "video long, frame_idx long, ts_ms long, track_id long, cls int, conf double, x double, y double, width double, height double, ended boolean"
    seen = [(7, 1, 40, 1, 5, 0.5, 0.0, 0.0, 1.0, 1.0, False), (7, 0, 0, 1, 4, 0.5, 0.0, 0.0, 1.0, 1.0, False), (7, 0, 0, 0, 4, 0.5, 0.0, 0.0, 1.0, 1.0, False), (7, None, 90, 1, None, None, None, None, None, None, True)]
    videos = spark.createDataFrame([(7, 25.0, 80), (8, 25.0, 0)], "video long, fps double, duration_ms long")
    tracks = exports.track_files(videos, spark.createDataFrame(seen, shape))
    files.write_named(exports.report_files(report, images.limit(1).select("image", F.struct("x").alias("record")), exports.label_files(images, boxes)).union(records).union(tracks), f"{tmp_path}/run")
    assert json.loads((tmp_path / "run/7.json").read_text()) == {
        "src": 7, "fps": 25.0, "duration_ms": 80,
        "tracks": [{"id": 1, "cls": 4, "ended": True, "frames": [{"frame_idx": k, "ts_ms": 40 * k, "conf": 0.5, "rect": {"x": 0.0, "y": 0.0, "width": 1.0, "height": 1.0}} for k in (0, 1)]}],
    }
    assert json.loads((tmp_path / "run/8.json").read_text())["tracks"] == []
    assert json.loads((tmp_path / "run/hop_m3/a.json").read_text()) == {"x": 0.5, "none": None}
    assert json.loads((tmp_path / "run/mining_report.json").read_text())["review"] == 1 and (tmp_path / "run/labels/b.txt").read_text().startswith("0 0.333333 ")
