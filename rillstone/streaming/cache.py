"""The enrichment cache as a stream: micro-batches of requests, resumed from a checkpoint.

What a key was answered is kept as the stream's keyed state, so a batch costs what it holds, whatever the cache has grown to.
A batch's answers are one folder, written anew if the batch runs again: after a crash the answers of all finished
batches stand, and only those of the batch under way are asked for again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rillstone.operators.enrichment import TRANSIENT_MARKS, cacheable, compact_cache, pending
from rillstone.sources.rest import Pacing, fetch_one, http_get


def read_cache(spark, path: str) -> DataFrame:
    """``key, payload, error`` as last written for each key; an empty table before the first batch."""
    schema = "key string, payload string, error string, batch long"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema).drop("batch")
    return compact_cache(spark.read.schema(schema).parquet(path), "key", "batch", ["payload", "error"])


def enrich_stream(requests: DataFrame, path: str, checkpoint: str, fetch: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Start a query that fetches keys the cache lacks and appends what isn't a passing error.

    ``requests`` is a stream with ``key`` and what ``fetch`` needs; ``fetch`` returns key, payload, error. A batch that
    runs again after a failure finds the keys it has written and fetches the rest.
    """

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        wanted = pending(df, read_cache(spark, path), "key")
        todo = df.join(wanted, "key", "left_semi").dropDuplicates(["key"])
        cacheable(fetch(todo), "error").withColumn("batch", F.lit(number).cast("long")).write.mode("append").parquet(path)

    return requests.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _into_batches(path: str) -> Callable[[DataFrame, int], None]:
    def write(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def answers_stream(requests: DataFrame, path: str, checkpoint: str, get: Callable[[str, float], str] = http_get, pacing: Pacing = Pacing(), workers: int = 1) -> StreamingQuery:
    """Start a query that asks the service for every key (``key, url``) it has no lasting answer to, once.

    The state of a key is the error of its answer ('' if there is none); passing errors leave no state, so that the key
    is asked for again when it comes again. ``workers`` tasks share the service's rate. Their number, and with it the
    state's partitions, is the checkpoint's for good.
    """
    share = Pacing(pacing.rate * workers, pacing.jitter, pacing.attempts, pacing.factor, pacing.timeout)

    def ask(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        urls = [u for frame in frames for u in frame["url"]]
        if state.exists:
            return
        url = next((u for u in urls if u), None)
        payload, error = fetch_one(url, get, share) if url else (None, "no query")
        if not any(m in error for m in TRANSIENT_MARKS):
            state.update((error,))
        yield pd.DataFrame({"key": [key[0]], "payload": [payload], "error": [error]})

    found = requests.where("key <> ''").groupBy("key").applyInPandasWithState(ask, "key string, payload string, error string", "error string", "append", GroupStateTimeout.NoTimeout)
    spark = requests.sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(workers))  # a query keeps the setting it was started with
    try:
        return found.writeStream.outputMode("append").foreachBatch(_into_batches(path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def durable_fetch(folder: str, get: Callable[[str, float], str] = http_get, pacing: Pacing = Pacing(), workers: int = 1, batch: int = 20) -> Callable[[DataFrame], DataFrame]:
    """A function of requests (``key, url``) to their answers that survives its end: a later call asks for the rest only.

    Below ``folder``: ``requests``, files of at most ``batch`` rows, one for each micro-batch; ``answers``; ``checkpoint``.
    """

    def fetch(requests: DataFrame) -> DataFrame:
        spark = requests.sparkSession
        wanted = requests.select("key", "url").where("key <> ''").dropDuplicates(["key"])
        known = cacheable(read_cache(spark, f"{folder}/answers"), "error").select("key")
        wanted.join(known, "key", "left_anti").repartition(workers).sortWithinPartitions("key").write.mode("append").option("maxRecordsPerFile", batch).parquet(f"{folder}/requests")
        rows = spark.readStream.schema("key string, url string").option("maxFilesPerTrigger", 1).parquet(f"{folder}/requests")
        query = answers_stream(rows, f"{folder}/answers", f"{folder}/checkpoint", get, pacing, workers)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        return wanted.select("key").join(read_cache(spark, f"{folder}/answers"), "key").select("key", "payload", "error")

    return fetch


def latest_stream(changes: DataFrame, path: str, checkpoint: str, key: str, seq: str, values: list[str], error: str) -> StreamingQuery:
    """Start a query that keeps the last lasting record of each key as state and writes those a batch has changed."""
    last = compact_cache(cacheable(changes, error), key, seq, values)
    return last.writeStream.outputMode("update").foreachBatch(_into_batches(path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, ts: str = "ts", late: str = "10 minutes", size: str = "1 hour", by: str = "event_type") -> DataFrame:
    """Events per window and kind with late rows up to a watermark; for streams and batches alike."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, size).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")
