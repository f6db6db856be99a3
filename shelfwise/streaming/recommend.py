"""Recommendations for a stream of queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from shelfwise.operators.similarity import prepare_side, topk_similar


def stream_recommend(queries: DataFrame, catalogue: DataFrame, out: str, checkpoint: str,
                     k: int = 5, *, candidate_key: str = "candidate_id",
                     vector: str = "embedding", **options) -> StreamingQuery:
    """Answer each micro-batch of query vectors against a static catalogue.

    Every batch writes a folder of its own and overwrites it when it is
    repeated, so a restart never emits a hit twice. The catalogue is prepared
    once, not per batch.
    """
    prepared = prepare_side(catalogue, candidate_key, vector)

    def answer(batch: DataFrame, batch_id: int) -> None:
        topk_similar(batch, prepared, k, vector=vector, **options).write.mode("overwrite").parquet(
            f"{out}/batch_id={batch_id}")

    return (queries.writeStream.foreachBatch(answer)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
