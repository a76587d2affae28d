"""Literal cases, specifications in plain Python, readers and streams."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from annolake.functions import geometry
from annolake.operators import labels, matching, tracking
from annolake.sources import formats, sinks

BOX = "image_id long, src int, idx long, cls int, x1 double, y1 double, x2 double, y2 double, conf double"


def overlap(a, b):
    """IoU of two (x1, y1, x2, y2), written out."""
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = w * h if w > 0 and h > 0 else 0.0
    whole = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
    return both / whole if whole > 0 else 0.0


# areas by hand: 6 and 12 with 2 in common; 8 inside 32; one edge in common; a line in a box; two equal boxes
@pytest.mark.parametrize(
    ("a", "b", "expected"),
    [((0, 0, 3, 2), (2, 0, 5, 4), 2 / 16), ((1, 1, 3, 5), (0, 0, 4, 8), 8 / 32), ((0, 0, 1, 3), (1, 0, 2, 3), 0), ((0, 1, 4, 1), (0, 0, 4, 4), 0), ((2, 3, 7, 4), (2, 3, 7, 4), 1)],
)
def test_iou(spark, a, b, expected):
    lit = lambda box: tuple(F.lit(float(v)) for v in box)
    assert spark.range(1).select(geometry.iou(lit(a), lit(b))).first()[0] == pytest.approx(expected)


def random_boxes(seed):
    rng, rows = random.Random(seed), []
    for image in range(30):
        for src in range(4):
            for idx in range(rng.randint(0, 4)):
                x, y = rng.randint(0, 6) / 16, rng.randint(0, 3) / 16
                rows.append((image, src, idx, 0, x, y, x + 0.25, y + 0.25, rng.randint(0, 4) / 4))
    return rows


def consensus_spec(rows, sources, least, agree):
    out = []
    for image in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == image and r[1] in sources), key=lambda r: (-r[8], r[1], r[2]))
        used = set()
        for seed in own:
            if seed[1:3] in used:
                continue
            group = [seed[1:3]]
            for s in sources:
                near = [(overlap(seed[4:8], r[4:8]), r[2]) for r in own if r[1] == s and s != seed[1] and r[1:3] not in used and overlap(seed[4:8], r[4:8]) >= least]
                if near:
                    group.append((s, max(near)[1]))
            used |= set(group)
            if len(group) >= agree:
                out.append((image, tuple(group)))
    return sorted(out)


def test_consensus_and_dispute_against_specification(spark):
    rows = random_boxes(5)
    df, weights = spark.createDataFrame(rows, BOX), {1: 0.25, 2: 0.25, 3: 0.5}
    found = sorted((r.image_id, tuple((s.src, s.idx) for s in r.supporters)) for r in matching.consensus(df, [1, 2, 3], 0.3, 2).collect())
    expected = consensus_spec(rows, [1, 2, 3], 0.3, 2)
    assert found == expected
    cover = spark.createDataFrame([(i, s, (i, s) != (7, 2)) for i in range(30) for s in range(4)], "image_id long, src int, ok boolean")
    scores = {r.image_id: r.score for r in matching.dispute_scores(df, cover, 0, weights, 0.3, 2).collect()}
    assert 7 not in scores and len(scores) == 29
    by_key = {r[:3]: r[4:8] for r in rows}
    for image, score in scores.items():
        mine = [r[4:8] for r in rows if r[0] == image and r[1] == 0]
        want = 0.0
        for box in mine:
            near = {r[1] for r in rows if r[0] == image and r[1] in weights and overlap(box, r[4:8]) >= 0.3}
            want += 1 - sum(weights[s] for s in near) if len(near) < 2 else 0
        for i, group in expected:
            if i == image and not any(overlap(b, by_key[(i, *group[0])]) >= 0.3 for b in mine):
                want += sum(weights[s] for s, _ in group)
        assert score == pytest.approx(want)


def test_box_tracks_keep_and_end_ids():
    t = tracking.BoxTracks(max_age=1)
    assert t.step([(0, 0, 1, 1)]) == ([1], [])
    assert t.step([(0.05, 0, 1, 1), (5, 5, 1, 1)]) == ([1, 2], [])
    assert t.step([]) == ([], [])
    assert t.step([(5, 5, 1, 1)]) == ([2], [1])
    assert tracking.BoxTracks(min_hits=2).step([(0, 0, 1, 1)]) == ([0], [])


def test_vector_tracks():
    t = tracking.VectorTracks()
    assert t.step(0, [([1.0, 0.0], (0.5, 0.5)), ([0.0, 0.0], (0.5, 0.5)), (None, (0.5, 0.5))]) == ([1, 0, 0], [])
    assert t.step(1000, [([0.9, 0.1], (0.5, 0.5)), ([0.0, 1.0], (0.5, 0.5))]) == ([1, 2], [])
    assert t.step(2000, [([1.0, 0.0], (0.95, 0.95))]) == ([3], [])  # too far away
    assert t.step(700_000, []) == ([], [(1, 601_001), (2, 601_001), (3, 602_001)])


def test_pose_gate():
    g = tracking.PoseGate(min_hits=2, key_every=5)
    assert [g.step(0, f, 0.5) for f in (0, 1, 2, 3)] == [False, True, False, False]
    assert g.step(0, 4, 0.9) and g.step(0, 9, 0.9) and not g.step(1, 10, 0.9)


def test_readers_and_exact_lines(spark, tmp_path):
    (tmp_path / "labels").mkdir()
    (tmp_path / "labels/a.b.txt").write_text("1 0.5 0.6 0.3 0.4\n\n2 0.1 0.1 0.1 0.1\n")
    assert [(r.image, r.line_no, r.class_id, r.x_center) for r in formats.darknet(spark, str(tmp_path / "labels")).collect()] == [("a.b", 0, 1, 0.5), ("a.b", 2, 2, 0.1)]
    (tmp_path / "labels/bad.txt").write_text("1 0.5\n")
    with pytest.raises(Exception, match="not a label line"):
        formats.darknet(spark, str(tmp_path / "labels")).collect()
    assert formats.darknet(spark, str(tmp_path / "labels"), strict=False).count() == 2
    (tmp_path / "c.json").write_text(json.dumps({"categories": [{"id": 1, "name": "p"}], "images": [{"id": 1, "file_name": "x.jpg", "width": 10, "height": 20}, {"id": 2, "file_name": "y.jpg", "width": 1, "height": 1}], "annotations": [{"image_id": 1, "category_id": 1, "bbox": [1, 2, 3, 4]}]}))
    assert sorted((r.image_id, r.name, r.h) for r in formats.coco(spark, str(tmp_path / "c.json")).collect()) == [(1, "p", 4.0), (2, None, None)]
    (tmp_path / "gt.txt").write_text("1,1,0,0,5,5,1,1,1\n1,2,0,0,5,5,1,3,1\n2,1,0,0,5,5,0,7,1\n")
    assert formats.mot(spark, str(tmp_path / "gt.txt")).count() == 2
    (tmp_path / "k.txt").write_text("Car 0.0 1 -1.5 1 2 3 4 1 1 1 0 0 0 0.1\n")
    assert formats.kitti(spark, str(tmp_path / "k.txt")).first().x2 == 3.0
    (tmp_path / "v.xml").write_text("<annotation><size><width>9</width><height>8</height></size><object><name>p</name><bndbox><xmin>1</xmin><ymin>2</ymin><xmax>3</xmax><ymax>4</ymax></bndbox></object></annotation>")
    assert tuple(formats.voc(spark, str(tmp_path / "v.xml")).first()) == ("v", 9.0, 8.0, "p", 1.0, 2.0, 3.0, 4.0)
    (tmp_path / "o.odgt").write_text(json.dumps({"ID": "i", "gtboxes": [{"tag": "person", "fbox": [1, 2, 3, 4], "head_attr": {"ignore": 1}}, {"tag": "person", "fbox": [5, 6, 7, 8]}, {"tag": "mask", "fbox": [0, 0, 1, 1]}]}))
    assert [tuple(r) for r in formats.crowd(spark, str(tmp_path / "o.odgt")).collect()] == [("i", 5.0, 6.0, 7.0, 8.0)]
    rows = spark.createDataFrame([("i", 0, 0, 0.0000005, 0.1234565, 0.2, 0.2), ("i", 1, -1, 0.0, 0.0, 0.0, 0.0)], "image string, idx int, class_id int, cx double, cy double, w double, h double")
    assert sinks.yolo_texts(rows).first().text == "0 0.000000 0.123456 0.200000 0.200000"


def test_text_rules(spark):
    one = spark.range(1)
    assert one.select(labels.weights(F.lit(" a:0.4,,b : 0.35,"))).first()[0] == {"a": 0.4, "b": 0.35}
    assert one.select(labels.event_span(F.lit("fall,2.0-5.0"))).first()[0] == ("fall", 2.0, 5.0)
    for bad in ("fall", "fall,5-2", ",1-2", "a,b,1-2", "a,nan-2", "a,-1-2"):
        assert one.select(labels.event_span(F.lit(bad))).first()[0] is None
    with pytest.raises(Exception, match="must be positive"):
        one.select(labels.uniform_times(F.lit(1.0), F.lit(0))).collect()


def test_consensus_and_disputes_bring_the_boxes_of_an_image_together_once(spark, capsys):
    df, cover = spark.createDataFrame(random_boxes(5), BOX), spark.createDataFrame([(1, 0, True)], "image_id long, src int, ok boolean")
    dealt = df.repartition(7, "image_id")
    for found, most in ((matching.consensus(dealt, [1, 2, 3], 0.3, 2), 1), (matching.dispute_scores(dealt, cover, 0, {1: 0.5, 2: 0.5}, 0.3, 2), 4)):
        capsys.readouterr()
        found.explain()
        assert capsys.readouterr().out.count("Exchange ") <= most


def test_images_that_span_batches_of_arrow_stay_whole(spark):
    rows = random_boxes(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        found = sorted((r.image_id, tuple((s.src, s.idx) for s in r.supporters)) for r in matching.consensus(spark.createDataFrame(rows, BOX), [1, 2, 3], 0.3, 2).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == consensus_spec(rows, [1, 2, 3], 0.3, 2)


def test_boxes_are_dealt_and_sorted_once(spark, capsys):
    from annolake.plans.fixtures import boxes

    boxes(spark, "/root/testdata/sf0.001").groupBy("image_id").count().explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange ") == 1 and plan.count("Sort [") == 1


def test_merged_boxes_are_not_dealt_by_class(spark, capsys):
    from annolake.operators import curation

    rows = spark.range(1000).selectExpr("id as stem", "cast(id % 2 as int) as cls")
    classes = spark.createDataFrame([("a", 0, 5), ("a", 1, 6), ("b", 1, 5)], "source string, cls int, to int")
    out = curation.merged({"a": rows, "b": rows}, classes)
    assert out.count() == 1500
    capsys.readouterr()
    out.explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_many_vectors_are_dealt_into_as_many_blocks_as_few():
    from annolake.operators import similarity

    assert [similarity._blocks(n) for n in (0, 1, 4096, 4097, 50_000, 600_000, 786_432, 786_433)] == [1, 1, 1, 2, 12, 12, 12, 13]
