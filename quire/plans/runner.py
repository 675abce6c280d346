"""Plan runner: stages as a graph of functions from DataFrames to a DataFrame.

A recipe is a list of stages ``{id, module, needs, params, schema}``. Stages are put in
topological order; module defaults, schema defaults and overrides are merged; the
columns that a stage's consumers ask for are checked before anything runs. Lineage is
lazy; a stage's result is written only if a folder is given, and then resumed from it.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Module:
    """A registered operator: ``run(inputs, params)``; ``requires`` are columns asked of each input."""

    run: Callable[[dict[str, DataFrame], dict[str, Any]], DataFrame]
    params: dict[str, dict[str, Any]] = field(default_factory=dict)
    requires: tuple[str, ...] = ()
    produces: tuple[str, ...] = ()


class PlanError(ValueError):
    """A recipe that cannot run."""


def merge_params(spec: dict[str, dict[str, Any]], overrides: dict[str, Any], stage: str = "") -> dict[str, Any]:
    """Defaults under overrides, checked: unknown, required, type, enum, bounds."""
    unknown = sorted(set(overrides) - set(spec))
    if unknown:
        raise PlanError(f"{stage}: unknown parameters {unknown}")
    out = {}
    kinds = {"string": str, "integer": int, "number": (int, float), "boolean": bool}
    for name, s in spec.items():
        value = overrides.get(name, s.get("default"))
        if value is None:
            if s.get("required"):
                raise PlanError(f"{stage}: {name} is required")
            out[name] = None
            continue
        kind = kinds.get(s.get("type", ""), object)
        if not isinstance(value, kind) or (isinstance(value, bool) and s.get("type") in ("integer", "number")):
            raise PlanError(f"{stage}: {name} must be {s['type']}")
        if "enum" in s and value not in s["enum"]:
            raise PlanError(f"{stage}: {name} must be one of {s['enum']}")
        if "minimum" in s and value < s["minimum"] or "maximum" in s and value > s["maximum"]:
            raise PlanError(f"{stage}: {name} is out of bounds")
        out[name] = value
    return out


def order_stages(stages: list[dict]) -> list[dict]:
    """Topological order that keeps the recipe's order where it can; cycles and unknown needs are errors."""
    by_id = {}
    for s in stages:
        if s["id"] in by_id:
            raise PlanError(f"stage {s['id']} occurs twice")
        by_id[s["id"]] = s
    for s in stages:
        for n in s.get("needs", ()):
            if n not in by_id:
                raise PlanError(f"{s['id']} needs unknown stage {n}")
    done: list[dict] = []
    left = list(stages)
    while left:
        ready = next((s for s in left if all(any(d["id"] == n for d in done) for n in s.get("needs", ()))), None)
        if ready is None:
            raise PlanError(f"cycle among {[s['id'] for s in left]}")
        left.remove(ready)
        done.append(ready)
    return done


def downstream(stages: list[dict], start: str) -> list[str]:
    """A stage and all that need it, in order: what a restart from it makes stale."""
    stale = {start}
    for s in order_stages(stages):
        if stale & set(s.get("needs", ())):
            stale.add(s["id"])
    return [s["id"] for s in order_stages(stages) if s["id"] in stale]


def validate(stages: list[dict], registry: dict[str, Module]) -> None:
    """Modules exist, parameters hold, and every input's producer has the columns that are asked for."""
    ordered = order_stages(stages)
    modules = {}
    for s in ordered:
        if s["module"] not in registry:
            raise PlanError(f"{s['id']}: unknown module {s['module']}")
        modules[s["id"]] = m = registry[s["module"]]
        merge_params(m.params, s.get("params", {}), s["id"])
        for n in s.get("needs", ()):
            made = modules[n].produces
            lacking = [c for c in m.requires if made and c not in made]
            if lacking:
                raise PlanError(f"{s['id']}: {n} does not produce {lacking}")


def run(spark: SparkSession, stages: list[dict], registry: dict[str, Module], sources: dict[str, DataFrame] | None = None, folder: str | None = None, start_from: str | None = None) -> dict[str, DataFrame]:
    """Results by stage id. With ``folder`` each result is written as Parquet and a state file records it; finished stages are read again unless ``start_from`` makes them stale."""
    validate(stages, registry)
    state_path = Path(folder, "state.json") if folder else None
    state = json.loads(state_path.read_text()) if state_path and state_path.exists() else {}
    stale = set(downstream(stages, start_from)) if start_from else set()
    out: dict[str, DataFrame] = {}
    for s in order_stages(stages):
        at = f"{folder}/{s['id']}" if folder else None
        if at and state.get(s["id"]) == "done" and s["id"] not in stale:
            out[s["id"]] = spark.read.parquet(at)
            continue
        m = registry[s["module"]]
        inputs = {**(sources or {}), **{n: out[n] for n in s.get("needs", ())}}
        df = m.run(inputs, merge_params(m.params, s.get("params", {}), s["id"]))
        if at:
            df.write.mode("overwrite").parquet(at)
            state[s["id"]] = "done"
            state_path.write_text(json.dumps(state, indent=2))
            df = spark.read.parquet(at)
        out[s["id"]] = df
    return out
