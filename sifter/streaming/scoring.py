"""Corpus mode for documents that arrive on a stream.

Each micro-batch of arriving documents ``(id, text)`` is scored against a static
corpus with the batch plan (``compare_corpus``); the result of epoch ``e`` is
written to ``<out>/epoch=e`` with ``overwrite``, so a replayed epoch replaces its
own rows instead of duplicating them (the sink is idempotent per epoch). Stream
progress lives in a checkpoint under the session's shared folder, one per output
path, unless a location is given.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sifter.params import Params
from sifter.plans.analysis import Prepared, compare_corpus
from sifter.session import shared_dir


def score_arrivals(arrivals: DataFrame, corpus: DataFrame | Prepared, q_id: str, d_id: str, params: Params,
                   out_path: str, checkpoint: str | None = None, top_n: int | None = 10,
                   available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start the stream: ``arrivals`` is a streaming frame with ``q_id`` and ``text``;
    ``corpus`` a static frame with ``d_id`` and ``text``, or better a prepared corpus,
    which every micro-batch reads instead of working on the texts again. Returns the
    running query."""
    spark = arrivals.sparkSession
    ckpt = checkpoint or f"{shared_dir(spark)}/streams/{hashlib.sha256(out_path.encode()).hexdigest()[:16]}"

    def one_batch(batch: DataFrame, epoch_id: int) -> None:
        res = compare_corpus(batch.select(q_id, "text"), corpus, q_id, d_id, params, top_n=top_n)
        (res.withColumn("epoch", F.lit(epoch_id))
         .write.mode("overwrite").parquet(f"{out_path}/epoch={epoch_id}"))

    writer = arrivals.select(q_id, "text").writeStream.foreachBatch(one_batch).option("checkpointLocation", ckpt)
    if processing_time is not None:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
