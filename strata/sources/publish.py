"""Write, audit, publish: tables that readers see together or not at all.

A run writes its tables to a folder of its own, their keys are checked on
what was written, and only then the run enters the log and becomes current.
A run that fails a check leaves the last good one in place.  The log keeps a
small file a run, so readers can ask for the tables as of a time, and old or
refused runs can be expired.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators import assert_constraints
from .partitions import hadoop_path
from .sinks import write_pointer, write_table


class NotPublished(LookupError):
    pass


class Publication:
    """The published runs under ``root``: ``runs/<id>/<table>``, ``log/<id>.json`` and ``current_run``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, run_id: str, table: str) -> str:
        return f"{self.root}/runs/{run_id}/{table}"

    def write(self, run_id: str, name: str, df: DataFrame, schema: StructType | None = None) -> DataFrame:
        """Write a table of a run and return it as written."""
        write_table(df, self.path(run_id, name), schema)
        return self.spark.read.parquet(self.path(run_id, name))

    def commit(self, run_id: str, tables: list[str]) -> None:
        """Enter a run into the log and make it the current one."""
        entry = {"run_id": run_id, "published_at": datetime.now(timezone.utc).isoformat(timespec="microseconds"), "tables": sorted(tables)}
        write_pointer(self.spark, f"{self.root}/log/{run_id}.json", json.dumps(entry))
        write_pointer(self.spark, f"{self.root}/current_run", run_id)

    def publish(self, tables: dict[str, DataFrame], constraints: Callable[[dict[str, DataFrame]], DataFrame] | None = None,
                run_id: str | None = None) -> str:
        """Write all tables, check their keys, publish; a violated key raises and publishes nothing."""
        run_id = run_id or uuid.uuid4().hex[:12]
        written = {name: self.write(run_id, name, df) for name, df in tables.items()}
        if constraints is not None:
            assert_constraints(constraints(written))
        self.commit(run_id, list(tables))
        return run_id

    def runs(self) -> list[dict]:
        """The published runs in order: run_id, published_at, tables (a small file each, read by the driver)."""
        path, fs = hadoop_path(self.spark, f"{self.root}/log")
        if not fs.exists(path):
            return []
        files = [s.getPath().toString() for s in fs.listStatus(path) if s.getPath().getName().endswith(".json")]
        rows = self.spark.read.schema("run_id string, published_at string, tables array<string>").json(files).collect() if files else []
        return sorted((r.asDict() for r in rows), key=lambda r: (r["published_at"], r["run_id"]))

    def run_as_of(self, as_of: str | None = None) -> dict:
        """The newest run, or the newest published at ``as_of`` (ISO text) or before."""
        runs = [r for r in self.runs() if as_of is None or r["published_at"] <= as_of]
        if not runs:
            raise NotPublished(f"nothing published under {self.root}" + (f" as of {as_of}" if as_of else ""))
        return runs[-1]

    def read(self, table: str, as_of: str | None = None) -> DataFrame:
        return self.spark.read.parquet(self.path(self.run_as_of(as_of)["run_id"], table))

    def expire(self, keep: int = 2) -> list[str]:
        """Delete the tables and log entries of all runs but the ``keep`` newest, and of runs never published."""
        if keep < 1:
            raise ValueError("the current run stays")
        stay = {r["run_id"] for r in self.runs()[-keep:]}
        path, fs = hadoop_path(self.spark, f"{self.root}/runs")
        gone = sorted(s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName() not in stay) if fs.exists(path) else []
        for run_id in gone:
            # The log first: a run that is listed always has its tables.
            fs.delete(hadoop_path(self.spark, f"{self.root}/log/{run_id}.json")[0], False)
            fs.delete(hadoop_path(self.spark, f"{self.root}/runs/{run_id}")[0], True)
        return gone
