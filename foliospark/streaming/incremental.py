"""Pages that arrive over time: each batch of files becomes artifacts once, with the same operators as a batch run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.operators.pages import page_artifacts
from foliospark.sources.jsonl import append_jsonl

_QA = T.StructType([T.StructField(n, T.StringType()) for n in ("question", "answer", "question_type", "difficulty", "citation_quote")])
PAGES = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("source_book", T.StringType()), T.StructField("source_page", T.IntegerType()),
    T.StructField("page_status", T.StringType()), T.StructField("page_text", T.StringType()), T.StructField("accepted_qas", T.ArrayType(_QA)),
])


def artifacts_of_arrivals(spark: SparkSession, arrivals: str, out: str, state: str, per_batch: int = 100) -> None:
    """Reads JSON lines that came into ``arrivals`` since the last call and appends their artifacts to ``out``.

    ``state`` keeps which files are done. A batch that is repeated after a crash is written to a folder of its own
    number again, so it replaces itself instead of being doubled.
    """

    def write(batch: DataFrame, number: int) -> None:
        page_artifacts(batch).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{out}/batch={number}")

    stream = spark.readStream.schema(PAGES).option("maxFilesPerTrigger", per_batch).json(arrivals)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def calls_per_window(calls: DataFrame, width: str = "1 hour", late: str = "2 days") -> DataFrame:
    """``window, call_type, n, latency_ms`` of calls (timestamp_epoch, call_type, latency_ms), for streams and tables: calls
    are counted in the window of their time, and rows later than ``late`` are dropped by a stream."""
    timed = calls.withColumn("at", F.timestamp_seconds("timestamp_epoch"))
    return timed.withWatermark("at", late).groupBy(F.window("at", width), "call_type").agg(F.count("*").alias("n"), F.sum("latency_ms").alias("latency_ms"))


__all__ = ["PAGES", "append_jsonl", "artifacts_of_arrivals", "calls_per_window"]
