"""A table with one row per key that micro-batches are merged into.

Rows lie in partitions by a hash of the key, and by a column of the key if one is named, such
as the day. A batch reads and replaces just the partitions that its keys fall into.

Changes and old rows meet in shuffled joins: a batch is as large as its stream makes it, and no
side of a merge is sent through the driver.

The merged partitions are staged as a whole before the table is touched. A batch that is
run again, whether it was lost before or after it touched the table, finds its own staged
rows and puts them in once more; without them the table is as it was before the batch. So
each batch counts once, sums included. Two staging folders are written in turn.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DELETED, BUCKET, RESET = "_deleted", "_bucket", "_reset"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the shared file system has this file or folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at)


@dataclass(frozen=True)
class KeyedTable:
    """`schema` names all columns. `by`, one of the keys, is a partition column above the hash. A
    null key is a key like any other.
    Columns in `add` are summed with what the key has; all others are replaced. In a table of
    `patches` a null in a change leaves the old value, unless `_reset` says that the old ones
    are gone."""

    path: str
    schema: str
    keys: list[str]
    by: str | None = None
    buckets: int = 8
    add: tuple[str, ...] = field(default=())
    patches: bool = False

    @property
    def parts(self) -> list[str]:
        return [c for c in (self.by, BUCKET) if c]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def _stored(self, spark: SparkSession, only: list | None) -> DataFrame:
        """All rows, or those of some values of `by`, for which no other folder is listed."""
        reader = spark.read.schema(f"{self.schema}, {DELETED} boolean, {BUCKET} int")
        root = f"{self.path}/rows"
        if only is not None:
            only = [f"{root}/{self.by}={v}" for v in only]
        found = [p for p in (only if only is not None else [root]) if exists(spark, p)]
        if not found:
            return spark.createDataFrame([], f"{self.schema}, {DELETED} boolean, {BUCKET} int")
        return reader.option("basePath", root).parquet(*found)

    def read(self, spark: SparkSession, only: list | None = None) -> DataFrame:
        """The rows that are not deleted; with `only`, those where `by` has one of these values."""
        return self._stored(spark, only).where(f"NOT {DELETED}").drop(DELETED, BUCKET)

    def near(self, keys: DataFrame) -> DataFrame:
        """The rows of the buckets that these keys fall into, for a table without `by`."""
        spark = keys.sparkSession
        touched = [r[0] for r in keys.select(self._bucket()).distinct().collect()]
        rows = self._stored(spark, None).where(F.col(BUCKET).isin(touched) & ~F.col(DELETED))
        return rows.drop(DELETED, BUCKET)

    def upsert(self, changes: DataFrame, batch_id: int) -> None:
        """Merge `changes`, one row per key. A true `_deleted` takes the row out; a later change of
        the key brings it back."""
        spark = changes.sparkSession
        staged = f"{self.path}/staged/slot={batch_id % 2}"
        if not self._is_staged(spark, staged, batch_id):
            if not self._stage(changes, staged, batch_id):
                return
        rows = spark.read.schema(self._staged_schema()).parquet(staged).drop("_batch")
        (
            rows.hint("rebalance", *[F.col(c) for c in self.parts])
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.parts).parquet(f"{self.path}/rows")
        )

    def _replaced(self, old: DataFrame, fresh: DataFrame) -> DataFrame:
        """The rows before whose keys the changes do not name."""
        named = fresh.select(*[F.col(k).alias(f"_of_{k}") for k in self.keys])
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in self.keys])
        return old.join(named.hint("merge"), same, "left_anti")

    def _patched(self, old: DataFrame, fresh: DataFrame) -> DataFrame:
        """The changed rows as a whole, with what they leave of the rows before."""
        same = reduce(and_, [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in self.keys])
        both = fresh.alias("n").join(old.where(f"NOT {DELETED}").hint("merge").alias("o"), same, "left")
        columns = [c for c in fresh.columns if c != RESET]
        kept = [c for c in columns if c not in (*self.keys, DELETED, BUCKET)]
        return both.select(*[
            F.coalesce(f"n.{c}", F.when(~F.col(f"n.{RESET}"), F.col(f"o.{c}"))).alias(c) if c in kept else F.col(f"n.{c}")
            for c in columns
        ])

    def _staged_schema(self) -> str:
        return f"{self.schema}, {DELETED} boolean, {BUCKET} int, _batch bigint"

    def _is_staged(self, spark: SparkSession, staged: str, batch_id: int) -> bool:
        if not exists(spark, f"{staged}/_SUCCESS"):
            return False
        row = spark.read.schema(self._staged_schema()).parquet(staged).select("_batch").first()
        return row is not None and row["_batch"] == batch_id

    def _stage(self, changes: DataFrame, staged: str, batch_id: int) -> bool:
        spark = changes.sparkSession
        gone = F.coalesce(F.col(DELETED), F.lit(False)) if DELETED in changes.columns else F.lit(False)
        names = [f.name for f in spark.createDataFrame([], self.schema).schema]
        reset = [F.coalesce(F.col(RESET), F.lit(False)).alias(RESET)] if self.patches else []
        fresh = changes.withColumn(DELETED, gone).select(*names, DELETED, self._bucket(), *reset).persist()
        try:
            # One row per partition touched: buckets times the values of `by` in the batch.
            touched = [tuple(r) for r in fresh.select(*self.parts).distinct().collect()]
            if not touched:
                return False
            old = self._stored(spark, sorted({t[0] for t in touched}) if self.by else None)
            mine = F.col(BUCKET).isin(sorted({t[-1] for t in touched}))
            if self.by:
                mine = F.struct(*self.parts).isin(*[F.struct(*map(F.lit, t)) for t in touched]) & mine
            old = old.where(mine)
            if self.add:
                values = [c for c in names if c not in self.keys]
                both = old.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)))
                last = F.max_by(F.struct(*values, DELETED), "_new")
                sums = {c: F.sum(c).alias(c) for c in self.add}
                merged = both.groupBy(*self.keys, BUCKET).agg(last.alias("_last"), *sums.values()).select(
                    *[F.col(c) if c in self.keys or c in sums else F.col(f"_last.{c}") for c in names],
                    F.col(f"_last.{DELETED}"), BUCKET,
                )
            else:
                merged = self._replaced(old, fresh).select(*names, DELETED, BUCKET).unionByName(
                    self._patched(old, fresh) if self.patches else fresh
                )
            merged.withColumn("_batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(staged)
        finally:
            fresh.unpersist()
        return True
