"""A catalogue that changes while queries stream in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.operators.similarity import Side, prepare_side, topk_similar


def versions(spark: SparkSession, store: str) -> list[int]:
    """Versions that were published whole, oldest first."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{store}/version=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return sorted(int(status.getPath().getParent().getName().removeprefix("version=")) for status in found)


def publish(catalogue: DataFrame, store: str) -> int:
    """Write the next version; readers see it once it is complete. One publisher at a time."""
    version = max(versions(catalogue.sparkSession, store), default=0) + 1
    catalogue.write.mode("overwrite").parquet(f"{store}/version={version}")
    return version


class CurrentCatalogue:
    """The newest version, prepared for comparison; prepared anew only when the version moves."""

    def __init__(self, spark: SparkSession, store: str, key: str, vector: str = "embedding"):
        self.spark, self.store, self.key, self.vector = spark, store, key, vector
        self.version, self.prepared = 0, None
        self.preparations = 0

    def side(self) -> Side:
        newest = max(versions(self.spark, self.store), default=0)
        if not newest:
            raise ValueError(f"no catalogue is published in {self.store}")
        if newest != self.version:
            old = self.prepared
            rows = self.spark.read.parquet(f"{self.store}/version={newest}")
            self.prepared, self.version = prepare_side(rows, self.key, self.vector), newest
            self.preparations += 1
            if old is not None and old.shared is not None:
                old.shared.unpersist()
        return self.prepared


def stream_recommend_current(queries: DataFrame, catalogue: CurrentCatalogue, out: str, checkpoint: str,
                             k: int = 5, trigger: dict | None = None, **options) -> StreamingQuery:
    """Answer each micro-batch against the catalogue as it is when the batch runs.

    Hits carry the version they were found in. A batch writes a folder of its
    own and overwrites it when it is repeated, so all its hits are of one
    version. `trigger` is that of the stream, by default all that is there.
    """

    def answer(batch: DataFrame, batch_id: int) -> None:
        side = catalogue.side()
        hits = topk_similar(batch, side, k, vector=catalogue.vector, **options)
        hits.withColumn("catalogue_version", F.lit(catalogue.version)).write.mode("overwrite").parquet(
            f"{out}/batch_id={batch_id}")

    return (queries.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
