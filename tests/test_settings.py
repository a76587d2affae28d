"""Settings from TOML: what is read, and what is an error."""

from __future__ import annotations

import pytest

from annolake.sources import settings


def put(tmp_path, text):
    (tmp_path / "run.toml").write_text(text)
    return str(tmp_path / "run.toml")


def test_settings_are_read(tmp_path):
    run = settings.load(settings.Run, put(tmp_path, 'tracker = "vectors"\nclasses = [0, 2]\nsample_fps = 5\n[vectors]\nttl_s = 30\n[gate]\nkey_every = 9\n'))
    assert run.options == settings.ByVectors(ttl_s=30.0) and run.gate == settings.Gate(key_every=9) and run.classes == (0, 2) and run.sample_fps == 5.0
    assert settings.load(settings.Run, put(tmp_path, "")).options == settings.ByBoxes()
    target = settings.load(settings.Target, put(tmp_path, 'name = "p"\nyolo_text = "t"\nvlm_prompt = "v"\nweights = {a = 0.4, b = 1}\n'))
    assert target.weights == {"a": 0.4, "b": 1.0} and target.rfdetr_cls_id is None
    assert settings.load(settings.Pool, put(tmp_path, 'datasets = ["x/COCO", "y/VOC"]')).datasets == ("x/COCO", "y/VOC")


@pytest.mark.parametrize(
    ("kind", "text", "fault"),
    [
        (settings.Run, 'tracker = "boxes"\n[vectors]\n', "takes no table vectors"), (settings.Run, 'tracker = "x"', "boxes or vectors"), (settings.Run, "colour = 1", "run.colour is not known"),
        (settings.Run, "[gate]\nkey_every = 1.5", "run.gate.key_every must be int"), (settings.Run, "classes = [0, true]", r"run.classes\[1\] must be int"), (settings.Run, "sample_fps = 0", "more than 0"),
        (settings.Run, "[boxes]\nleast = -1", "run.boxes: least must be more"), (settings.Run, "gate = 3", "must be a table"), (settings.Run, "a = = 1", "Invalid"),
        (settings.Target, 'name = "p"', "yolo_text is missing"), (settings.Target, 'name = " "\nyolo_text = ""\nvlm_prompt = ""\nweights = {}', "has a name"),
        (settings.Pool, 'datasets = ["x/A", "y/A"]', "of one name"), (settings.Pool, 'datasets = "x"', "must be a list"),
    ],
)
def test_faults_are_named(tmp_path, kind, text, fault):
    with pytest.raises(settings.SettingsError, match=fault):
        settings.load(kind, put(tmp_path, text))
