"""Named datasets that build on one another.

A flow is a function from a session to a DataFrame, registered under its name with
the flows it reads. Running writes each flow as parquet, to a folder of its own for every run, and then
registers what was written as a view: nothing is computed twice, re-runs replace what readers see, and a run that
breaks leaves the last whole result and its view as they were.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from smelter.operators.lineage import remove_scratch

logger = logging.getLogger(__name__)

REPORT_SCHEMA = "name string, status string, rows bigint, error string, seconds double"


# Name of the folders of a flow's runs, and how many whole ones stay: the newest, and one that readers may still be at.
RUN = "_run"
KEPT_RUNS = 2


def complete_runs(spark: SparkSession, folder: str) -> list[str]:
    """Folders of a flow's runs that were written to their end, oldest first."""
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    files = jvm.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = files.globStatus(jvm.Path(f"{folder}/{RUN}=*/_SUCCESS"))
    return sorted(str(s.getPath().getParent().toString()) for s in done or ())


def read_flow(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The newest whole result of a flow below ``path``, in any session."""
    runs = complete_runs(spark, f"{path}/{name}")
    if not runs:
        raise ValueError(f"{name} has no whole run in {path}")
    return spark.read.parquet(runs[-1])


@dataclass(frozen=True)
class Flow:
    build: Callable[[SparkSession], DataFrame]
    depends_on: tuple[str, ...]


class Flows:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._flows: dict[str, Flow] = {}

    def add(self, name: str, build: Callable[[SparkSession], DataFrame], depends_on: Sequence[str] = ()) -> None:
        """Register a flow; names in ``depends_on`` that are not flows are external tables."""
        self._flows[name] = Flow(build, tuple(depends_on))

    def materialized_view(self, depends_on: Sequence[str] = ()):
        """Register the decorated function under its own name."""
        def register(build):
            self.add(build.__name__, build, depends_on)
            return build
        return register

    def order(self) -> list[str]:
        graph = {name: [d for d in flow.depends_on if d in self._flows] for name, flow in self._flows.items()}
        try:
            return list(TopologicalSorter(graph).static_order())
        except CycleError as cycle:
            raise ValueError(f"flows depend on each other in a circle: {cycle.args[1]}") from cycle

    def _write(self, name: str) -> int:
        counted = Observation(name)
        rows = self._flows[name].build(self.spark).observe(counted, F.count(F.lit(1)).alias("rows"))
        rows.write.parquet(f"{self.path}/{name}/{RUN}={time.time_ns():020d}")
        read_flow(self.spark, self.path, name).createOrReplaceTempView(name)
        for old in complete_runs(self.spark, f"{self.path}/{name}")[:-KEPT_RUNS]:
            remove_scratch(self.spark, old)
        return counted.get["rows"]

    def run(self, on_error: str = "raise") -> DataFrame:
        """Write every flow, each after those it reads, and report on them.

        With ``on_error="skip"`` a failure does not stop unrelated flows; those that
        read the failed one, directly or not, are marked skipped.
        """
        if on_error not in ("raise", "skip"):
            raise ValueError("on_error must be 'raise' or 'skip'")
        report: list[tuple] = []
        broken: set[str] = set()
        for name in self.order():
            if broken.intersection(self._flows[name].depends_on):
                broken.add(name)
                report.append((name, "skipped", None, None, 0.0))
                continue
            started = time.monotonic()
            try:
                rows = self._write(name)
            except Exception as error:
                logger.error("%s failed: %s", name, error)
                if on_error == "raise":
                    raise
                broken.add(name)
                report.append((name, "error", None, str(error), time.monotonic() - started))
            else:
                logger.info("%s: %d rows", name, rows)
                report.append((name, "success", rows, None, time.monotonic() - started))
        return self.spark.createDataFrame(report, REPORT_SCHEMA)
