"""Settings of runs as frozen records read from TOML; a key that is not known, missing or of another kind is an error."""

from __future__ import annotations

import tomllib
import types
import typing
from dataclasses import MISSING, dataclass, field, fields, is_dataclass
from pathlib import PurePosixPath

from annolake.sources.files import store_of


class SettingsError(ValueError):
    """Names the place in the settings and what is wrong there."""


def _fits(value: object, kind: object) -> bool:
    if kind is float:
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    if kind is int:
        return isinstance(value, int) and not isinstance(value, bool)
    return isinstance(value, kind)


def record(kind: object, value: object, at: str = "settings") -> object:
    """``value`` as ``kind``: a record, a plain type, a list or map of one, or one of several (the first that fits)."""
    origin, args = typing.get_origin(kind), typing.get_args(kind)
    if origin in (typing.Union, types.UnionType):
        if value is None and type(None) in args:
            return None
        faults = []
        for one in (a for a in args if a is not type(None)):
            try:
                return record(one, value, at)
            except SettingsError as fault:
                faults.append(str(fault))
        raise SettingsError("; or ".join(faults))
    if origin in (list, tuple):
        if not isinstance(value, list):
            raise SettingsError(f"{at} must be a list")
        return tuple(record(args[0], x, f"{at}[{k}]") for k, x in enumerate(value))
    if origin is dict:
        if not isinstance(value, dict):
            raise SettingsError(f"{at} must be a table")
        return {k: record(args[1], x, f"{at}.{k}") for k, x in value.items()}
    if is_dataclass(kind):
        if not isinstance(value, dict):
            raise SettingsError(f"{at} must be a table")
        hints, known = typing.get_type_hints(kind), {f.name: f for f in fields(kind)}
        for k in value:
            if k not in known:
                raise SettingsError(f"{at}.{k} is not known; there are {', '.join(known)}")
        given = {k: record(hints[k], x, f"{at}.{k}") for k, x in value.items()}
        for f in known.values():
            if f.name not in given and f.default is MISSING and f.default_factory is MISSING:
                raise SettingsError(f"{at}.{f.name} is missing")
        try:
            return kind(**given)
        except SettingsError:
            raise
        except ValueError as fault:
            raise SettingsError(f"{at}: {fault}") from None
    if not _fits(value, kind):
        raise SettingsError(f"{at} must be {getattr(kind, '__name__', kind)}, not {value!r}")
    return float(value) if kind is float else value


def load(kind: type, path: str) -> object:
    """The settings file ``path`` as ``kind``."""
    store, own = store_of(path)
    with store.open_input_stream(own) as f:
        raw = f.read().decode()
    try:
        return record(kind, tomllib.loads(raw), PurePosixPath(own).stem)
    except tomllib.TOMLDecodeError as fault:
        raise SettingsError(f"{path}: {fault}") from None


def _positive(**values: float) -> None:
    for name, v in values.items():
        if v <= 0:
            raise ValueError(f"{name} must be more than 0")


@dataclass(frozen=True)
class Target:
    """What is looked for: its name, what each detector is asked, the weights of the validators."""

    name: str
    yolo_text: str
    vlm_prompt: str
    weights: dict[str, float]
    rfdetr_cls_id: int | None = None
    output_cls_id: int = 0

    def __post_init__(self):
        if not self.name.strip() or any(w < 0 for w in self.weights.values()):
            raise ValueError("a target has a name and weights of 0 or more")


@dataclass(frozen=True)
class Pool:
    """The data sets that are pooled, by folder."""

    datasets: list[str]

    def __post_init__(self):
        stems = [PurePosixPath(d).name for d in self.datasets]
        if len(set(stems)) < len(stems):
            raise ValueError("two data sets of one name would share their files' names")


@dataclass(frozen=True)
class ByBoxes:
    """Options of ``tracking.BoxTracks``."""

    least: float = 0.3
    max_age: int = 2
    min_hits: int = 1

    def __post_init__(self):
        _positive(least=self.least, min_hits=self.min_hits)


@dataclass(frozen=True)
class ByVectors:
    """Options of ``tracking.VectorTracks``."""

    least: float = 0.6
    radius: float = 0.3
    ttl_s: float = 600.0
    blend: float = 0.5

    def __post_init__(self):
        _positive(radius=self.radius, ttl_s=self.ttl_s)
        if not 0 <= self.blend <= 1:
            raise ValueError("blend must be from 0 to 1")


@dataclass(frozen=True)
class Gate:
    """Options of ``tracking.PoseGate``."""

    min_hits: int = 2
    key_every: int = 5
    shape_change: float = 0.3


@dataclass(frozen=True)
class Run:
    """A tracking run; ``tracker`` says which of the two tables holds its options, and the other must not be there."""

    tracker: str = "boxes"
    boxes: ByBoxes | None = None
    vectors: ByVectors | None = None
    gate: Gate = field(default_factory=Gate)
    classes: list[int] = ()
    sample_fps: float | None = None

    def __post_init__(self):
        if self.tracker not in ("boxes", "vectors"):
            raise ValueError("tracker must be boxes or vectors")
        other = "vectors" if self.tracker == "boxes" else "boxes"
        if getattr(self, other) is not None:
            raise ValueError(f"a tracker by {self.tracker} takes no table {other}")
        if self.sample_fps is not None:
            _positive(sample_fps=self.sample_fps)

    @property
    def options(self) -> ByBoxes | ByVectors:
        return getattr(self, self.tracker) or (ByBoxes() if self.tracker == "boxes" else ByVectors())
