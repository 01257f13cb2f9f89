"""A table of parquet files by day, changed one whole day at a time.

Layout: ``root/version=N/day=YYYY-MM-DD``. A version holds only the days that it
changed; the current content of a day is that of the highest finished version
having it. Nothing that is being read is ever overwritten, and a write that
dies leaves an unfinished version which no reader sees. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


class DayTable:
    def __init__(self, spark: SparkSession, root: str, schema: str, at: str):
        self.spark, self.root, self.schema, self.at = spark, root.rstrip("/"), schema, at

    def _list(self, path: str) -> list[str]:
        """Names in a folder of any file system Spark can reach."""
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(target):
            return []
        return [s.getPath().getName() for s in fs.listStatus(target)]

    def versions(self) -> list[int]:
        """Finished versions, oldest first."""
        found = (n.split("=")[1] for n in self._list(self.root) if n.startswith("version="))
        return sorted(
            int(v) for v in found if "_SUCCESS" in self._list(f"{self.root}/version={v}")
        )

    def days(self) -> dict[str, str]:
        """Current folder of each day."""
        current = {}
        for version in self.versions():
            folder = f"{self.root}/version={version}"
            for name in self._list(folder):
                if name.startswith("day="):
                    current[name[4:]] = f"{folder}/{name}"
        return current

    def read(self, days: Iterable[str] | None = None) -> DataFrame:
        current = self.days()
        wanted = current if days is None else [d for d in days if d in current]
        folders = [current[d] for d in sorted(wanted)]
        if not folders:
            return self.spark.createDataFrame(
                self.spark.sparkContext.emptyRDD(), StructType.fromDDL(self.schema)
            )
        return self.spark.read.schema(self.schema).parquet(*folders)

    def since(self, day: str) -> DataFrame:
        """The content of ``day`` and all later days; others are not opened."""
        return self.read([d for d in self.days() if d >= day])

    def days_of(self, rows: DataFrame) -> list[str]:
        """Days the rows lie in: one short string per day. Rows without a time lie in
        none; ``write`` refuses them."""
        found = rows.select(F.date_format(self.at, "yyyy-MM-dd").alias("d")).distinct()
        return sorted(r["d"] for r in found.collect() if r["d"] is not None)

    def write(self, rows: DataFrame) -> int:
        """Replaces every day that ``rows`` has rows of. Spark evens out the files,
        so a day with most of the rows is written by many tasks."""
        version = max(self._all_versions(), default=0) + 1
        rows = rows.withColumn(self.at, self._present())
        columns = StructType.fromDDL(self.schema).fieldNames()
        dated = rows.select(*columns, F.date_format(self.at, "yyyy-MM-dd").alias("day"))
        (
            dated.hint("rebalance", "day")
            .write.partitionBy("day")
            .parquet(f"{self.root}/version={version}")
        )
        return version

    def _present(self):
        """The row's time. A row without one has no day, so the write fails."""
        message = f"a row without {self.at} has no day"
        return F.coalesce(F.col(self.at), F.raise_error(F.lit(message)).cast("timestamp"))

    def _all_versions(self) -> list[int]:
        return [
            int(n.split("=")[1]) for n in self._list(self.root) if n.startswith("version=")
        ]
