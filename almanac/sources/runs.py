"""Runs of several stages that can be resumed, and that delete what is no longer read.

A run has a folder in a store that all executors share. Every stage is written there as a table, and a manifest has a
small file for each, written after its table: the fingerprint of the stage and its inputs, and whether the table is there
or was released. A run that is started again, after its driver was lost too, goes on behind the last finished stages. A
stage's table is deleted as soon as the last stage that reads it has ended.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from almanac.sources import files

DONE, RELEASED = "done", "released"


@dataclass(frozen=True)
class Stage:
    """A table made of the tables of other stages, or of sources. Change ``version`` when the function changes."""

    name: str
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...] = ()
    version: str = "1"


@dataclass
class Run:
    """Stages in an order in which they can be made; the last is the result.

    ``sources`` are paths of tables that stages may name as inputs; they are read as Parquet, and a change of their files
    makes all stages after them run again.
    """

    spark: SparkSession
    folder: str
    stages: list[Stage]
    sources: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.folder = self.folder.rstrip("/")
        self.by_name = {s.name: s for s in self.stages}
        known = set(self.sources)
        for stage in self.stages:
            missing = [i for i in stage.inputs if i not in known]
            if missing or stage.name in known:
                raise ValueError(f"stage {stage.name!r}: unknown inputs {missing} or a name that is taken")
            known.add(stage.name)
        self.fingerprints: dict[str, str] = {}

    def fingerprint(self, name: str) -> str:
        """A hash of the files of a source, or of a stage, its version and the fingerprints of its inputs."""
        if name not in self.fingerprints:
            if name in self.sources:
                said = files.stamp(self.spark, self.sources[name])
            else:
                stage = self.by_name[name]
                said = "\n".join([name, stage.version, *map(self.fingerprint, stage.inputs)])
            self.fingerprints[name] = hashlib.sha256(said.encode()).hexdigest()[:32]
        return self.fingerprints[name]

    def _table(self, name: str) -> str:
        return f"{self.folder}/{name}-{self.fingerprint(name)}"

    def state(self, name: str) -> str | None:
        """done, released, or None where the stage has not ended with these inputs."""
        said = files.get(self.spark, f"{self.folder}/manifest/{name}")
        entry = json.loads(said) if said else {}
        return entry.get("state") if entry.get("fingerprint") == self.fingerprint(name) else None

    def _note(self, name: str, state: str) -> None:
        entry = {"fingerprint": self.fingerprint(name), "state": state}
        files.put(self.spark, f"{self.folder}/manifest/{name}", json.dumps(entry))

    def _needed(self) -> set[str]:
        """Stages that still have to run: the result if it is not there, and what such a stage reads, unless it is there."""
        needed: set[str] = set()
        wanted = [self.stages[-1].name]
        while wanted:
            name = wanted.pop()
            if name in self.by_name and name not in needed and self.state(name) != DONE:
                needed.add(name)
                wanted += self.by_name[name].inputs
        return needed

    def read(self, name: str) -> DataFrame:
        path = self.sources[name] if name in self.sources else self._table(name)
        return self.spark.read.parquet(path)

    def result(self) -> DataFrame:
        """Run the stages that have to, and read the last. Tables of an earlier run with other inputs are deleted."""
        current = {f"{s.name}-{self.fingerprint(s.name)}" for s in self.stages}
        for name in files.names(self.spark, self.folder):
            if name != "manifest" and name not in current:
                files.delete(self.spark, f"{self.folder}/{name}")
        needed = self._needed()
        for place, stage in enumerate(self.stages):
            if stage.name not in needed:
                continue
            # What a lost driver left half written is no table: the manifest does not know it.
            files.delete(self.spark, self._table(stage.name))
            stage.build(*map(self.read, stage.inputs)).write.parquet(self._table(stage.name))
            self._note(stage.name, DONE)
            self._release(needed, place)
        if not needed:
            self._release(needed, len(self.stages) - 1)
        return self.read(self.stages[-1].name)

    def _release(self, needed: set[str], place: int) -> None:
        """Delete the tables that no stage after this one, of those that run, reads."""
        later = {i for s in self.stages[place + 1 :] if s.name in needed for i in s.inputs}
        for stage in self.stages[: place + 1]:
            last = stage is self.stages[-1]
            if not last and stage.name not in later and self.state(stage.name) == DONE:
                self._note(stage.name, RELEASED)
                files.delete(self.spark, self._table(stage.name))

    def close(self) -> None:
        """Delete the run, its result too."""
        files.delete(self.spark, self.folder)
