"""The commit log: which written folders make up which table.

``<root>/_log/<version>.json`` lists, for every table, its schema, how it is
bucketed and its folders, with the rows and the key range of each. A version is
created by one put-if-absent, so all tables change together or none does, and
of two loads that began from the same version the second is refused. Folders
that no version lists, of a load that broke off or still runs, are in no table.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from starmart.sinks import storage


class ConcurrentLoad(RuntimeError):
    """Another load committed first; this one has published nothing."""


@dataclass(frozen=True)
class Folder:
    name: str
    rows: int
    low: int | None = None  # of the table's surrogate key
    high: int | None = None
    first: str | None = None  # of the column that buckets the table
    last: str | None = None

    def meets(self, first: str, last: str) -> bool:
        """Whether a row of the folder may have its bucket column within these bounds."""
        return self.first is None or (self.first <= last and first <= self.last)


@dataclass(frozen=True)
class Table:
    schema: str  # JSON
    bucket_by: str | None = None
    buckets: int = 0
    folders: tuple[Folder, ...] = ()

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    @property
    def rows(self) -> int:
        return sum(f.rows for f in self.folders)

    @property
    def top(self) -> int:
        """The largest surrogate key, 0 without any."""
        return max((f.high for f in self.folders if f.high is not None), default=0)

    def plus(self, folder: Folder) -> Table:
        return replace(self, folders=(*self.folders, folder))


@dataclass(frozen=True)
class State:
    version: int = 0
    tables: dict[str, Table] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> State:
        said = json.loads(text)
        tables = {
            name: Table(t["schema"], t["bucket_by"], t["buckets"], tuple(Folder(**f) for f in t["folders"]))
            for name, t in said["tables"].items()
        }
        return cls(said["version"], tables)


class CommitLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root}/_log"

    def _path(self, version: int) -> str:
        return f"{self.folder}/{version:020d}.json"

    def versions(self) -> list[int]:
        names = [name for name, _, _ in storage.children(self.spark, self.folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def latest(self) -> State:
        found = self.versions()
        return State.from_json(storage.read_text(self.spark, self._path(found[-1]))) if found else State()

    def commit(self, after: State) -> None:
        """Publish ``after``; ``ConcurrentLoad`` if its version is there already."""
        if not storage.put_if_absent(self.spark, self._path(after.version), after.to_json()):
            raise ConcurrentLoad(f"version {after.version} was committed by another load")

    def forget_before(self, version: int) -> None:
        for v in self.versions():
            if v < version:
                storage.delete_path(self.spark, self._path(v))
