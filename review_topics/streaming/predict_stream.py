"""Score a stream of documents micro-batch by micro-batch."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from review_topics.plans.model import TopicModel
from review_topics.plans.predict import predict


def predict_stream(model: TopicModel, docs: DataFrame, encoder, target: str, checkpoint: str) -> StreamingQuery:
    """Append ``(doc_id, topic_id, probability, stream, batch_id)`` of all available input to ``target``.

    Every batch is an ordinary batch job. A batch is written to its own folder with overwrite, named by the stream's checkpoint and
    the number of the batch: a repeated batch replaces itself, and another stream into ``target`` replaces nothing.
    """
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def score(batch: DataFrame, batch_id: int) -> None:
        predict(model, batch, encoder).write.mode("overwrite").parquet(f"{target}/stream={stream}/batch_id={batch_id}")

    return (
        docs.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
