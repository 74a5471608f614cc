"""Dimensions that change while fact streams run: whole versions side by side.

A version is written once and never changed, so a stream that holds one for a while reads
the same rows in every batch until it takes the next. Old versions go by the storage's
retention, which has to outlast the longest interval at which readers refresh.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tonearm.sources.keyed import exists


@dataclass(frozen=True)
class Versions:
    path: str

    def publish(self, rows: DataFrame, version: int) -> None:
        """Writing a version again replaces it. It is visible once it is complete."""
        rows.write.mode("overwrite").parquet(f"{self.path}/version={version}")

    def newest(self, spark: SparkSession) -> int:
        root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        found = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(root)
        numbers = [int(s.getPath().getName().removeprefix("version=")) for s in found if s.isDirectory()]
        whole = [n for n in numbers if exists(spark, f"{self.path}/version={n}/_SUCCESS")]
        if not whole:
            raise ValueError(f"{self.path} holds no complete version")
        return max(whole)

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        at = self.newest(spark) if version is None else version
        return spark.read.parquet(f"{self.path}/version={at}")
