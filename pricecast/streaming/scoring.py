"""Requests as a stream. Each carries its own history, so scoring keeps no state and uses the batch functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pricecast.operators.governance import current_deployment
from pricecast.operators.score import derive_simple, score_with_bundle
from pricecast.sources.files import load_bundle

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("series_id", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("vol", T.DoubleType()),
        T.StructField("change_pct", T.DoubleType()),
        T.StructField("price_history", T.ArrayType(T.DoubleType())),
    ]
)


def read_requests(spark: SparkSession, folder: str, form: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(REQUEST_SCHEMA).format(form)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def start_scoring(requests: DataFrame, features: list[str], score: Callable[[DataFrame], DataFrame], out: str, state: str) -> StreamingQuery:
    """Score every micro-batch into ``out``: ``request_id``, ``prediction``, ``reason``.

    ``score`` gives ``request_id``, ``prediction`` and, where it has one, ``reason`` of the accepted requests. Refused
    requests come out beside them with a reason and no prediction, from the same query, so none is lost unseen. The
    file sink and the state folder give each request exactly one result after a restart.
    """
    good, bad = derive_simple(requests, features)
    scored = score(good)
    reason = F.col("reason") if "reason" in scored.columns else F.lit(None).cast("string")
    scored = scored.select("request_id", F.col("prediction").cast("double").alias("prediction"), reason.alias("reason"))
    refused = bad.select("request_id", F.lit(None).cast("double").alias("prediction"), "reason")
    return (
        scored.unionByName(refused)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )


def start_scoring_deployed(requests: DataFrame, root: str, model_name: str, out: str, state: str) -> StreamingQuery:
    """Score every micro-batch with the version deployed under ``root`` when the batch starts: ``request_id``,
    ``prediction``, ``reason``, ``version``.

    A version deployed while the stream runs is picked up by the next batch, without a restart. A batch writes a folder of
    its own, anew if it is run again, so each request has exactly one result.
    """

    def score(batch: DataFrame, number: int) -> None:
        version, path = current_deployment(batch.sparkSession, root, model_name)
        bundle = load_bundle(batch.sparkSession, path)
        good, bad = derive_simple(batch, bundle.features)
        scored = score_with_bundle(good, bundle)
        reason = F.col("reason") if "reason" in scored.columns else F.lit(None).cast("string")
        scored = scored.select("request_id", F.col("prediction").cast("double").alias("prediction"), reason.alias("reason"))
        refused = bad.select("request_id", F.lit(None).cast("double").alias("prediction"), "reason")
        results = scored.unionByName(refused).withColumn("version", F.lit(version).cast("long"))
        results.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return requests.writeStream.foreachBatch(score).option("checkpointLocation", state).trigger(availableNow=True).start()
