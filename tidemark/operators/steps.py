"""Chains of steps over versioned datasets: order, what is out of date, runs in parallel, snapshots, batches."""

from __future__ import annotations

import contextlib
import hashlib
import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from . import stores


class StepError(ValueError):
    """Steps that can't be run as they are given."""


@dataclass(frozen=True)
class Step:
    """A dataset made from others: inputs by role, parameters that JSON holds, and the function that makes its rows."""

    name: str
    inputs: Mapping[str, str]
    output: str
    make: Callable[[Mapping[str, DataFrame], Mapping], DataFrame]
    partition: Sequence[str]
    columns: Sequence[str]
    parameters: Mapping = field(default_factory=dict)
    after: Sequence[str] = ()


@dataclass(frozen=True)
class Outcome:
    name: str
    status: str  # made | current
    reason: str


def _read_json(spark: SparkSession, path: str) -> dict | None:
    place, files = stores._place(spark, path)
    return json.loads(spark.read.text(path, wholetext=True).first()[0]) if files.exists(place) else None


def _write_json(spark: SparkSession, path: str, body: dict, replace: bool) -> None:
    place, files = stores._place(spark, path)
    stream = files.create(place, replace)
    stream.write(bytearray(json.dumps(body, sort_keys=True).encode()))
    stream.close()


class Chain:
    """Steps whose inputs are other steps' outputs, or datasets that are there already."""

    def __init__(self, steps: Sequence[Step]):
        self.steps = {s.name: s for s in steps}
        makers = {s.output: s.name for s in steps}
        if len(self.steps) < len(steps) or len(makers) < len(steps):
            raise StepError("steps need names and outputs of their own")
        self.needs: dict[str, set[str]] = {}
        for step in steps:
            unknown = set(step.after) - self.steps.keys()
            if unknown:
                raise StepError(f"{step.name} comes after unknown steps {sorted(unknown)}")
            self.needs[step.name] = {makers[d] for d in step.inputs.values() if d in makers} | set(step.after)
        self.order()

    def order(self, targets: Sequence[str] | None = None) -> list[str]:
        """The steps that targets need, each after what it needs; of several the first given comes first."""
        wanted = list(self.steps if targets is None else targets)
        if unknown := [t for t in wanted if t not in self.steps]:
            raise StepError(f"unknown steps {unknown}")
        needed: set[str] = set()
        while wanted:
            name = wanted.pop()
            if name not in needed:
                needed.add(name)
                wanted += self.needs[name]
        out: list[str] = []
        left = [n for n in self.steps if n in needed]
        while left:
            ready = next((n for n in left if self.needs[n] <= set(out)), None)
            if ready is None:
                raise StepError(f"steps need each other: {left}")
            out.append(ready)
            left.remove(ready)
        return out

    def _state(self, spark: SparkSession, root: str, step: Step) -> dict:
        """What a step's rows depend on: its inputs' versions and its parameters."""
        versions = {}
        for role, dataset in step.inputs.items():
            found = stores.read_manifest(spark, f"{root}/{dataset}")
            if found is None:
                raise StepError(f"{step.name}: no dataset {dataset}")
            versions[role] = found["version"]
        return {"inputs": versions, "parameters": json.loads(json.dumps(dict(step.parameters), sort_keys=True))}

    def out_of_date(self, spark: SparkSession, root: str, name: str) -> str:
        """Why a step must run; '' if its inputs, parameters and output are as its last run left them."""
        step = self.steps[name]
        record = _read_json(spark, f"{root}/steps/{name}.json")
        if record is None:
            return "never run"
        now = self._state(spark, root, step)
        for what in ("inputs", "parameters"):
            changed = sorted(k for k in {*record[what], *now[what]} if record[what].get(k) != now[what].get(k))
            if changed:
                return f"{what} changed: {', '.join(changed)}"
        made = stores.read_manifest(spark, f"{root}/{step.output}")
        if made is None:
            return "output missing"
        return "" if made["version"] == record["output"] else "output changed"

    def _run(self, spark: SparkSession, root: str, name: str, forced: bool) -> Outcome:
        step = self.steps[name]
        reason = "forced" if forced else self.out_of_date(spark, root, name)
        if not reason:
            return Outcome(name, "current", "")
        state = self._state(spark, root, step)
        inputs = {}
        for role, dataset in step.inputs.items():
            manifest = stores.read_manifest(spark, f"{root}/{dataset}", state["inputs"][role])
            inputs[role] = stores.read_version(spark, f"{root}/{dataset}", manifest["keys"], manifest["version"])
        version = stores.publish(step.make(inputs, step.parameters), f"{root}/{step.output}", step.partition, step.columns)
        _write_json(spark, f"{root}/steps/{name}.json", state | {"output": version}, True)
        return Outcome(name, "made", reason)

    def run(self, spark: SparkSession, root: str, targets: Sequence[str] | None = None, force: Sequence[str] = (), together: int = 2) -> list[Outcome]:
        """Run what is out of date, up to `together` steps at once; after a failure nothing new starts, and the first one is raised."""
        pending = self.order(targets)
        planned, outcomes, running, failure = list(pending), {}, {}, None
        with ThreadPoolExecutor(together) as pool:
            while pending or running:
                for name in [n for n in pending if self.needs[n] <= outcomes.keys()] if failure is None else []:
                    if len(running) < together:
                        pending.remove(name)
                        running[pool.submit(self._run, spark, root, name, name in force)] = name
                if not running:
                    break
                for future in wait(running, return_when=FIRST_COMPLETED).done:
                    name = running.pop(future)
                    try:
                        outcomes[name] = future.result()
                    except Exception as error:  # the first failure is raised when all that runs has ended
                        failure = failure or error
        if failure is not None:
            raise failure
        return [outcomes[n] for n in planned]


def snapshot(spark: SparkSession, root: str, datasets: Sequence[str], description: str) -> str:
    """Pin the datasets' current versions under an id that the versions alone decide."""
    refs = {}
    for dataset in sorted(datasets):
        found = stores.read_manifest(spark, f"{root}/{dataset}")
        if found is None:
            raise StepError(f"no dataset {dataset}")
        refs[dataset] = found["version"]
    name = hashlib.sha256(json.dumps(refs, sort_keys=True).encode()).hexdigest()[:16]
    path = f"{root}/snapshots/{name}.json"
    if _read_json(spark, path) is None:
        _write_json(spark, path, {"refs": refs, "description": description}, False)
    return name


def pinned(spark: SparkSession, root: str, name: str) -> dict[str, str]:
    """A snapshot's versions; each must still be there."""
    found = _read_json(spark, f"{root}/snapshots/{name}.json")
    if found is None:
        raise StepError(f"no snapshot {name}")
    lost = [d for d, v in found["refs"].items() if stores.read_manifest(spark, f"{root}/{d}", v) is None]
    if lost:
        raise StepError(f"snapshot {name} has lost {lost}")
    return found["refs"]


@contextlib.contextmanager
def batch(spark: SparkSession, root: str, name: str, datasets: Sequence[str]) -> Iterator[None]:
    """Datasets that are published together: until the block ends well, readers refuse them."""
    path = f"{root}/batches/{name}.json"
    _write_json(spark, path, {"datasets": sorted(datasets)}, False)
    yield
    place, files = stores._place(spark, path)
    files.delete(place, False)


def refuse_unfinished(spark: SparkSession, root: str, dataset: str) -> None:
    """An error if a batch that holds the dataset hasn't ended."""
    place, files = stores._place(spark, f"{root}/batches")
    for f in files.listStatus(place) if files.exists(place) else ():
        body = _read_json(spark, f.getPath().toString())
        if body and dataset in body["datasets"]:
            raise StepError(f"{dataset} is part of an unfinished batch, {f.getPath().getName()}")


def published_keys(spark: SparkSession, root: str, partition: Sequence[str], key: str, except_partition: str | None = None) -> DataFrame:
    """Every key of the current version with the partition that holds it; one partition may be left out."""
    rows = stores.read_version(spark, root, partition).select(key, *partition)
    return rows if except_partition is None else rows.where(~rows[partition[0]].eqNullSafe(except_partition))
