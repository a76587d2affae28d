"""Injected stages: a model applied to columns in batches, with its result and its error as two nullable columns.

A stage is made by a factory on each worker, once for all the partitions that the worker is given, and is called with
lists of ``batch`` rows at most. It may be any object with ``__call__(rows) -> results``. A batch that fails is called
again row by row, so one bad row costs its own result and no other; a row whose columns are all null is not given to the
stage. Counts come with the data: ``observed`` adds them to the job that runs anyway.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Stage(Protocol):
    def __call__(self, rows: list[dict]) -> list: ...


_made: dict[str, Stage] = {}


def _own(name: str, make: Callable[[], Stage]) -> Stage:
    """The stage ``name`` of this worker; a worker serves one application, so names are those of its driver."""
    if name not in _made:
        _made[name] = make()
    return _made[name]


def _called(stage: Stage, rows: list[dict]) -> list[tuple[object, str | None]]:
    try:
        out = stage(rows)
        if len(out) != len(rows):
            raise ValueError(f"{len(out)} results for {len(rows)} rows")
        return [(x, None) for x in out]
    except Exception as error:  # noqa: BLE001  whatever a model raises is its row's error
        if len(rows) == 1:
            return [(None, f"{type(error).__name__}: {error}")]
        return [x for r in rows for x in _called(stage, [r])]


def staged(rows: DataFrame, name: str, make: Callable[[], Stage], columns: list[str], result: T.DataType, *, batch: int = 64) -> DataFrame:
    """``rows`` with ``result`` and ``error`` of the stage that ``make`` builds, for the values of ``columns``; columns of these names are an error."""
    clash = {"result", "error"} & set(rows.columns)
    if clash:
        raise ValueError(f"the rows have a column {sorted(clash)[0]} already")
    names = rows.columns
    at = [names.index(c) for c in columns]
    shape = T.StructType([*rows.schema, T.StructField("result", result), T.StructField("error", T.StringType())])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        stage, kind = _own(name, make), to_arrow_type(result)
        for b in batches:
            given = [dict(zip(columns, r, strict=True)) for r in zip(*(b.column(k).to_pylist() for k in at), strict=True)]
            todo = [k for k, r in enumerate(given) if any(v is not None for v in r.values())]
            results, errors = [None] * len(given), [None] * len(given)
            for first in range(0, len(todo), batch):
                own = todo[first : first + batch]
                for k, (x, e) in zip(own, _called(stage, [given[k] for k in own]), strict=True):
                    results[k], errors[k] = x, e
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(results, kind), pa.array(errors, pa.string())], [*names, "result", "error"])

    return rows.toDF(*[f"c{k}" for k in range(len(names))]).mapInArrow(run, shape)


def observed(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``rows`` of ``staged``, and an observation of how many there were, had a result, and failed; read it after an action."""
    seen = Observation(name)
    return rows.observe(seen, F.count("*").alias("rows"), F.count("result").alias("results"), F.count("error").alias("errors")), seen
