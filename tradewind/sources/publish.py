"""Result tables that readers never see half written.

A run writes all its tables into a folder of its own and then adds a state that names them. Readers open the tables of
the last state. A run that dies before that leaves the state before it as it is; its folder is removed with the old ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from .files import read_parquet, table_path, write_table
from .scratch import remove_folder
from .snapshots import Snapshots

# Jobs that the driver hands to Spark at a time.
SIDE_BY_SIDE = 4


def side_by_side(spark: SparkSession, jobs: Sequence[Callable[[], object]], threads: int = SIDE_BY_SIDE) -> list:
    """The results of independent jobs, run from a few driver threads; small tables don't wait for each other's tasks.
    Raises the first failure once all have ended."""
    with ThreadPoolExecutor(max(1, min(threads, len(jobs)))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [r.result() for r in running]


class Published:
    """Versions of a set of result tables below one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.states = Snapshots(spark, f"{self.folder}/_published")

    def publish(self, write: Callable[[str], Sequence[str]]) -> int:
        """``write`` writes tables into the folder it is given and returns their names. Tables of the version before that
        it doesn't write stay. Returns the number of the new version."""
        number, state = self.states.latest()
        version = f"version-{uuid.uuid4().hex}"
        names = write(f"{self.folder}/{version}")
        return self.states.commit(number, {"tables": {**state.get("tables", {}), **dict.fromkeys(names, version)}})

    def publish_tables(self, tables: Mapping[str, DataFrame], compression: str = "zstd") -> int:
        def write(folder: str) -> list[str]:
            one = lambda name, df: lambda: write_table(df, table_path(folder, name), compression=compression)
            side_by_side(self.spark, [one(*x) for x in tables.items()])
            return list(tables)

        return self.publish(write)

    def path(self, table: str, version: int | None = None) -> str:
        state = self.states.latest()[1] if version is None else self.states.read(version)
        if not state or table not in state["tables"]:
            raise KeyError(f"{self.folder} has no published table {table}")
        return table_path(f"{self.folder}/{state['tables'][table]}", table)

    def open(self, table: str, version: int | None = None) -> DataFrame:
        """A table of the last version, or of a numbered one."""
        return read_parquet(self.spark, self.path(table, version))

    def tables(self) -> list[str]:
        return sorted(self.states.latest()[1].get("tables", {}))

    def remove_old(self, keep: int = 2) -> list[str]:
        """Remove the folders that none of the last ``keep`` versions names, those of dead runs too; returns them. Not
        to be called while another job publishes."""
        states = [self.states.read(n) for n in self.states.numbers()]
        used = {v for s in [s for s in states if s][-keep:] for v in s["tables"].values()}
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [str(f.getPath().getName()) for f in files.listStatus(path)] if files.exists(path) else []
        old = sorted(n for n in found if n.startswith("version-") and n not in used)
        for name in old:
            remove_folder(self.spark, f"{self.folder}/{name}")
        return old
