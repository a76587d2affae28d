"""Label sets read from folders, names, and writers."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from annolake.operators import labels, labelsets, matching, review, similarity
from annolake.sources import formats, sinks
from annolake.sources import labelsets as sets


def put(path, text="x"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_folders(spark, tmp_path):
    put(tmp_path / "hop_m3" / "x.json", json.dumps({"user": "u", "extra": 1}))
    put(tmp_path / "deep" / "er" / "y_m3.todo", "t")
    put(tmp_path / "set" / "4" / "p.jpg")
    put(tmp_path / "set" / "other" / "q.jpg")
    for side in ("A", "B", "label"):
        put(tmp_path / side / "one.png")
    put(tmp_path / "A" / "two.png")
    root = str(tmp_path)
    row = sets.label_pairs(spark, root, "hop", 3, "user string").first()
    assert row.image == root + "/image/x.jpg" and row.label.user == "u"
    assert [r.text for r in sets.todo_labels(spark, root, 3).collect()] == ["t"]
    assert {(r.stem, r.cls) for r in sets.pictures(spark, root + "/set").collect()} == {("p", 4), ("q", None)}
    assert [r.stem for r in sets.picture_triplets(spark, root).collect()] == ["one"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sets.label_pairs(spark, root, "hop", 4, "user string")


def test_meta_values_follow_the_common_ones(spark, tmp_path):
    value = lambda k: {"id": k, "name": str(k)}
    put(tmp_path / "m1.json", json.dumps({"name": "m", "properties": [{"name": "early", "values": [value(9)]}, {"name": "common", "values": [value(1)]}, {"name": "p", "values": [value(2)]}]}))
    got = {r.name: [v.id for v in r["values"]] for r in sets.meta(spark, str(tmp_path / "m1.json")).collect()}
    assert got == {"early": [9], "common": [1], "p": [1, 2]}


@pytest.mark.parametrize(("text", "names"), [("names: ['a', b]\n", ["a", "b"]), ("nc: 2\nnames:\n- a\n- 'b c'\n", ["a", "b c"]), ("names:\n  0: a\n  1: b\nnc: 2\n", ["a", "b"]), ("nc: 1\n", [])])
def test_names(text, names):
    assert sets.names_of_yaml(text) == names


def test_lines_and_records(spark, tmp_path):
    row = spark.createDataFrame([(1, 0.5, 1 / 3, 1e-7, 1.0, None)], "c int, x double, y double, w double, h double, none string")
    assert row.select(sinks.short_line("c", "x", "y", "w", "h")).first()[0] == "1 0.5 0.333333 1e-07 1 "
    sinks.write_records(row, str(tmp_path / "out"))
    assert json.loads(spark.read.text(str(tmp_path / "out")).first()[0])["none"] is None


def test_looks(spark):
    one = spark.range(1)
    assert one.select(labelsets.blinks(F.lit(0.6), 0.5, 0.25), labelsets.blinks(F.lit(0.8), 0.5, 0.25), labelsets.blinks(F.lit(0.0), 0.0, 1.0)).first()[:] == (False, True, False)
    assert one.select(labelsets.safe_name(F.lit("!!"))).first()[0] == "kw"


@pytest.mark.parametrize("ratio", [0.0, 0.3, 0.5, 1.0])
def test_review_of_many_ties(spark, ratio):
    rows = [(k, float(k % 4) / 4) for k in range(200)]
    got = {r.image_id: r.route for r in matching.review_set(spark.createDataFrame(rows, "image_id long, score double"), ratio).collect()}
    doubtful = sorted((r for r in rows if r[1] > 0), key=lambda r: (-r[1], r[0]))
    wanted = {r[0] for r in doubtful[: int(len(doubtful) * ratio)]}
    assert got == {k: "l0" if s == 0 else "review" if k in wanted else "l1" for k, s in rows}


def test_weights_keep_digits_equal_to_their_place(spark):
    assert spark.range(1).select(labels.weights(F.lit("0a:0.50, b:1 ,c:2"))).first()[0] == {"0a": 0.5, "b": 1.0, "c": 2.0}


def test_names_with_quotes_comments_and_brackets():
    assert sets.names_of_yaml("# about\nnc: 2\nnames: ['a, b', \"c # d\", e-f]  # three\n") == ["a, b", "c # d", "e-f"]
    assert sets.names_of_yaml("names: [one,\n  two, # second\n  three]\npath: x\n") == ["one", "two", "three"]
    assert sets.names_of_yaml("names:\n  1: b\n  0: a\n  # none\n  10: 'k: l'\ntrain: t\n") == ["a", "b", "k: l"]
    assert sets.names_of_yaml("names: {1: b, 0: a}\n") == ["a", "b"] and sets.names_of_yaml("names:\n- 'x y'\n-  z\nnc: 2\n") == ["x y", "z"]
    assert sets.names_of_yaml("path: names\n") == sets.names_of_yaml("") == sets.names_of_yaml("names: []\n") == []


def test_label_lines_of_just_five(spark):
    files = spark.createDataFrame([("a", "1 0.5 0.5 0.1 0.1\n2 0.5 0.5 0.1 0.1 0.9\n3 0.5\nx 1 1 1 1\n")], "image string, text string")
    read = lambda **o: [r.class_id for r in labels.darknet_lines(files, strict=False, **o).orderBy("line_no").collect()]
    assert read() == [1, 2] and read(more=False) == [1]


def test_rows_and_features_written(spark, tmp_path):
    rows = spark.createDataFrame([("Car", 0.0, 1, -1.5)], "cls string, trunc double, occl int, alpha double")
    sinks.write_kitti(rows, str(tmp_path / "k"))
    assert spark.read.text(str(tmp_path / "k")).first()[0] == "Car 0.0 1 -1.5"
    with pytest.raises(Exception, match="already exists"):
        sinks.write_kitti(rows, str(tmp_path / "k"))
    v = spark.createDataFrame([([0.5, 2.0], 3)], "v array<double>, label int").coalesce(1)
    sinks.write_features(v, "v", 2, "label", str(tmp_path / "f"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "f")).collect()] == ["c0,c1,label", "0.5,2.0,3"]


def test_answers_of_results(spark, tmp_path):
    said = [{"image": "a", "detections": [{"label": "x", "bbox": [0, 0, 1, 1], "conf": 0.5}, {"label": "y", "bbox": [0, 0, 1, 1], "conf": 1}]}, {"image": "b", "detections": []}, {"image": "c", "error": "no answer"}]
    (tmp_path / "r.jsonl").write_text("\n".join(json.dumps(x) for x in said))
    got = formats.answers(spark, str(tmp_path / "r.jsonl")).collect()
    assert sorted((r.image, r.label or "", r.error or "") for r in got) == [("a", "x", ""), ("a", "y", ""), ("b", "", ""), ("c", "", "no answer")]


def test_numbers_beyond_four_digits(spark):
    rows = review.numbered(spark.range(10_005).withColumn("image", F.lit(1)), "image", "id")
    assert rows.select("serial").distinct().count() == 10_005 and rows.where("id = 10000").first().serial == "_10001" and rows.where("id = 0").first().serial == "_0001"


def test_review_by_share_and_by_score(spark):
    scores = [0.0] * 5 + [1.0] * 7 + [0.5 + k / 1000 for k in range(20)] + [2.0, 1.5, 1e-9]
    rows = spark.createDataFrame(list(enumerate(scores)), "image_id long, score double")
    for ratio in (0.0, 0.1, 0.2, 0.35, 1.0):
        ordered = sorted((k for k, s in enumerate(scores) if s > 0), key=lambda k: (-scores[k], k))
        want = set(ordered[: int(len(ordered) * ratio)])
        got = {r.image_id: r.route for r in matching.review_set(rows, ratio).collect()}
        assert got == {k: "l0" if s <= 0 else "review" if k in want else "l1" for k, s in enumerate(scores)}
    got = {r.image_id: r.route for r in matching.review_set(rows, 0.0, least=1.0).collect()}
    assert got == {k: "l0" if s <= 0 else "review" if s >= 1 else "l1" for k, s in enumerate(scores)}
    assert matching.review_set(rows.where("score < 0"), 0.3).collect() == []


def test_core_sets(spark):
    import random

    rng = random.Random(4)
    data = [(g * 100 + i, [g * 10 + rng.random(), g * -7 + rng.random()]) for g in range(5) for i in range(30)] + [(999, None)]
    v = spark.createDataFrame(data, "vec_id long, v array<double>")
    kept = similarity.core_set(v, 5).collect()
    assert len({r.cluster for r in kept}) == len(kept) <= 5 and {r.vec_id // 100 for r in kept} == {0, 1, 2, 3, 4}
    held = dict(data)
    for g in range(5):  # one for each heap, the member nearest to its middle
        own = {i: x for i, x in held.items() if x and i // 100 == g}
        middle = [sum(x[k] for x in own.values()) / 30 for k in (0, 1)]
        assert min(own, key=lambda i: sum((a - b) ** 2 for a, b in zip(own[i], middle, strict=True))) in {r.vec_id for r in kept}
