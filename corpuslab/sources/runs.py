"""Analysis runs stored as a whole: index, reports and snapshots of a run appear together."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from . import manifests


class Run:
    """The staged tables of one run; nothing of it is visible before ``publish``."""

    def __init__(self, store: Runs, name: str, number: int, former: dict):
        self.store, self.name, self.number, self.former = store, name, number, former
        self.folder = f"{name}-{uuid.uuid4().hex[:12]}"
        self.tables: dict[str, dict] = {}

    def write(self, table: str, rows: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """Stage a table and give it back as it was written."""
        if table in self.tables:
            raise ValueError(f"table {table!r} is staged twice")
        path = f"{self.folder}/{table}"
        rows.write.partitionBy(*(partition_by or [])).parquet(f"{self.store.root}/{path}")
        self.tables[table] = {"path": path, "schema": rows.schema.json()}
        return self.store._read(self.tables[table])

    def publish(self) -> None:
        """Make all staged tables visible at once; they replace an earlier run of the same name."""
        runs = {**self.former, self.name: self.tables}
        manifests.publish(self.store.spark, self.store.root, self.number, {"runs": runs})


class Runs:
    """Runs below ``root``, named so that their names sort by time (days in ISO form).

    Readers follow the newest manifest, which names every table of every run.  A run that
    ends between two of its writes leaves the former state; what it staged is removed by
    ``forget_unpublished``.  Two writers that began from the same state cannot both publish.
    Nulls, repeated rows and empty tables are stored as they are.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _newest(self) -> tuple[int, dict]:
        found = manifests.numbers(self.spark, self.root)
        if not found:
            return -1, {}
        content = manifests.load(self.spark, self.root, found[-1])
        if not isinstance(content.get("runs"), dict):
            raise ValueError(f"{self.root}: manifest {found[-1]} names no runs")
        return found[-1], content["runs"]

    def _read(self, entry: dict) -> DataFrame:
        schema = StructType.fromJson(json.loads(entry["schema"]))
        return self.spark.read.schema(schema).parquet(f"{self.root}/{entry['path']}")

    def names(self) -> list[str]:
        """The published runs, oldest first."""
        return sorted(self._newest()[1])

    def begin(self, name: str) -> Run:
        """A new run.  A former state that cannot be read is an error before anything is written."""
        number, former = self._newest()
        for run, tables in former.items():
            for table, entry in tables.items():
                if not manifests.exists(self.spark, f"{self.root}/{entry['path']}/_SUCCESS"):
                    raise ValueError(f"{self.root}: table {table!r} of run {run!r} is missing or incomplete")
        return Run(self, name, number + 1, former)

    def table(self, table: str, run: str | None = None, before: str | None = None) -> DataFrame | None:
        """A table of a run, by default the newest, or the newest before a name; None where there is none."""
        runs = self._newest()[1]
        wanted = [n for n in sorted(runs) if (run is None or n == run) and (before is None or n < before)]
        entry = runs[wanted[-1]].get(table) if wanted else None
        return None if entry is None else self._read(entry)

    def forget_unpublished(self) -> list[str]:
        """Remove the folders that no run of the newest manifest names; only while no run is being written."""
        live = {entry["path"].split("/")[0] for tables in self._newest()[1].values() for entry in tables.values()}
        dead = [f for f in manifests.folders(self.spark, self.root) if f != manifests.FOLDER and f not in live]
        for folder in dead:
            manifests.remove(self.spark, f"{self.root}/{folder}")
        return dead
