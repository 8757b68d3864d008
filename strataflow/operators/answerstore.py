"""Current answers in buckets of keys: a base, and deltas of single puts that are merged when read.

A put is a row with a sequence; the highest sequence of a question is its answer, whenever it arrived, and an empty value
takes the answer away. A batch of puts is a delta of its own, and a batch written again replaces itself.
Merging writes new bases for the buckets that deltas have touched, and for no others; which base of a bucket counts, and
up to which batch, is written last, so a merge that fails changes nothing. Taken-away answers stay in the base with their
sequence, as an older put may still come.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.session import stage

ROWS = "fingerprint long, question string, value string, sequence long, batch_id long"
STATE = "bucket int, generation long, upto long, written long"


@dataclass(frozen=True)
class AnswerStore:
    spark: SparkSession
    path: str
    buckets: int = 64

    def bucket_of(self, fingerprint: Column) -> Column:
        return F.pmod(F.xxhash64(fingerprint), F.lit(self.buckets)).cast("int")

    def put(self, changes: DataFrame, batch_id: int) -> None:
        """Add ``fingerprint, question, value, sequence``; batches have growing numbers."""
        rows = changes.select(
            F.col("fingerprint").cast("long").alias("fingerprint"), "question", F.col("value").cast("string").alias("value"),
            F.col("sequence").cast("long").alias("sequence"),
        ).withColumn("bucket", self.bucket_of(F.col("fingerprint")))
        newest = _newest(rows.withColumn("batch_id", F.lit(batch_id).cast("long")), ["bucket"]).drop("batch_id")
        newest.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/deltas/batch_id={batch_id}")

    def _exists(self, name: str) -> bool:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def state(self) -> DataFrame:
        """For each bucket that has a base: its generation, and the last batch in it."""
        if not self._exists("state"):
            return self.spark.createDataFrame([], STATE)
        rows = self.spark.read.schema(STATE).parquet(f"{self.path}/state")
        return rows.groupBy("bucket").agg(F.max_by(F.struct("generation", "upto"), "written").alias("s")).select("bucket", "s.*")

    def _base(self) -> DataFrame:
        if not self._exists("base"):
            return self.spark.createDataFrame([], f"{ROWS}, bucket int, generation long")
        rows = self.spark.read.schema(f"{ROWS}, bucket int, generation long").parquet(f"{self.path}/base")
        return rows.join(self.state().select("bucket", "generation"), ["bucket", "generation"], "left_semi")

    def _deltas(self) -> DataFrame:
        """Deltas that are in no base yet."""
        if not self._exists("deltas"):
            return self.spark.createDataFrame([], f"{ROWS}, bucket int")
        rows = self.spark.read.schema(f"{ROWS}, bucket int").parquet(f"{self.path}/deltas")
        merged = self.state().select("bucket", "upto")
        return rows.join(merged, "bucket", "left").where(F.col("upto").isNull() | (F.col("batch_id") > F.col("upto"))).drop("upto")

    def current(self, fingerprints: Sequence[int] | None = None) -> DataFrame:
        """``fingerprint, question, value`` now; of some fingerprints only their buckets are read."""
        base, deltas = self._base().drop("generation"), self._deltas()
        if fingerprints is not None:
            own = self.spark.createDataFrame([(f,) for f in fingerprints], "fingerprint long")
            numbers = [r[0] for r in own.select(self.bucket_of(F.col("fingerprint"))).distinct().collect()]
            wanted = F.col("bucket").isin(numbers) & F.col("fingerprint").isin(list(fingerprints))
            base, deltas = base.where(wanted), deltas.where(wanted)
        newest = _newest(base.unionByName(deltas), [])
        return newest.where(F.trim("value") != "").select("fingerprint", "question", "value")

    def merge(self) -> int:
        """Write new bases for the buckets that have deltas; returns how many."""
        deltas = stage(self._deltas())
        touched = stage(deltas.groupBy("bucket").agg(F.max("batch_id").alias("upto")))
        count = touched.count()
        if not count:
            return 0
        last = self.state().agg(F.max("generation")).first()[0]
        generation = 1 if last is None else last + 1
        base = self._base().drop("generation").join(touched.select("bucket"), "bucket", "left_semi")
        rows = _newest(base.unionByName(deltas), ["bucket"]).withColumn("generation", F.lit(generation).cast("long"))
        # One folder per bucket and generation; a failed merge of the same generation is overwritten.
        dealt = rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        dealt.partitionBy("generation", "bucket").parquet(f"{self.path}/base")
        numbered = touched.select("bucket", F.lit(generation).cast("long").alias("generation"), "upto", F.lit(generation).cast("long").alias("written"))
        numbered.write.mode("overwrite").parquet(f"{self.path}/state/merge={generation}")
        return count


def _newest(rows: DataFrame, more: list[str]) -> DataFrame:
    """The put with the highest sequence of every question; of equal ones the later batch, then the higher value."""
    order = F.struct("sequence", "batch_id", F.col("value").isNotNull(), "value")
    newest = rows.groupBy("fingerprint", "question", *more).agg(F.max_by(F.struct("value", "sequence", "batch_id"), order).alias("_row"))
    return newest.select("fingerprint", "question", *more, "_row.*")
