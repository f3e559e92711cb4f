"""Bar files, stage tables, JSON reports and fitted models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricecast.config import RAW_COLUMNS, public_name
from pricecast.operators.trees import Forest


def require_columns(df: DataFrame, required: list[str] | tuple[str, ...]) -> DataFrame:
    """The frame itself, or an error naming the columns it lacks."""
    lacking = [c for c in required if c not in df.columns]
    if lacking:
        raise ValueError(f"the table has no column named {', '.join(lacking)}")
    return df


def trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def read_raw_bars(spark: SparkSession, path: str, series_id: str | None = None) -> DataFrame:
    """CSV bars as text, with ``_seq`` giving the place of a row: file, split start, row within the split.

    Column types are never inferred. ``series_id`` names the one series of a file without that column.
    A path that does not exist is an error.
    """
    header = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    text = spark.read.schema(schema).option("header", True).csv(path)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    df = text.select(*[F.col(f"`{c}`").alias(c.strip()) for c in header], place.alias("_seq"))
    if "series_id" not in df.columns:
        df = df.withColumn("series_id", F.lit(series_id or "series"))
    return require_columns(df, RAW_COLUMNS)


def ingest_report(raw: DataFrame) -> DataFrame:
    """Row count of a raw table and the number of its columns, library columns left out."""
    width = len([c for c in raw.columns if c in RAW_COLUMNS])
    return raw.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(width).cast("long"))


def ingest(spark: SparkSession, src: str, dst: str, series_id: str | None = None) -> DataFrame:
    """Copy CSV bars to Parquet and report rows and columns."""
    from pyspark.sql import Observation

    counted = Observation("ingest")
    raw = read_raw_bars(spark, src, series_id)
    raw.observe(counted, F.count("*").alias("n_rows")).write.mode("overwrite").parquet(dst)
    width = len([c for c in raw.columns if c not in ("_seq", "series_id")])
    return spark.createDataFrame([(counted.get["n_rows"], width)], "n_rows long, n_columns long")


def write_stage(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), as_csv: bool = False) -> None:
    """Stage table as Parquet, or as CSV with the public column names."""
    if as_csv:
        df.select([F.col(f"`{c}`").alias(public_name(c)) for c in df.columns]).write.mode("overwrite").csv(path, header=True)
    else:
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """Struct rows as JSON documents."""
    df.write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


@dataclass
class Bundle:
    """A deployed model: coefficient table, or pipeline or forest with the moments of its series, and the features in order."""

    model: PipelineModel | DataFrame | Forest
    features: list[str]
    moments: DataFrame | None = None


def save_bundle(bundle: Bundle, path: str, positions: DataFrame) -> None:
    """Write ``model``, ``features`` (rows position, feature) and ``moments``, where it has them, under a folder."""
    if isinstance(bundle.model, DataFrame):
        bundle.model.write.mode("overwrite").parquet(f"{path}/model")
    elif isinstance(bundle.model, Forest):
        bundle.model.nodes.write.mode("overwrite").parquet(f"{path}/model")
    else:
        save_model(bundle.model, f"{path}/model")
    if bundle.moments is not None:
        bundle.moments.write.mode("overwrite").parquet(f"{path}/moments")
    positions.write.mode("overwrite").parquet(f"{path}/features")
    kind = "coefficients" if isinstance(bundle.model, DataFrame) else "pipeline" if bundle.moments is None else "scaled_pipeline"
    kind = "forest" if isinstance(bundle.model, Forest) else kind
    positions.sparkSession.range(1).select(F.lit(kind).alias("kind")).coalesce(1).write.mode("overwrite").json(f"{path}/kind")


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    """What :func:`save_bundle` wrote."""
    features = [r.feature for r in spark.read.parquet(f"{path}/features").orderBy("position").collect()]  # a row a feature
    kind = spark.read.schema("kind string").json(f"{path}/kind").first().kind
    if kind == "coefficients":
        return Bundle(spark.read.parquet(f"{path}/model"), features)
    if kind == "forest":
        nodes = spark.read.parquet(f"{path}/model")
        return Bundle(Forest(nodes, features, nodes.agg(F.max("tree")).first()[0] + 1), features, spark.read.parquet(f"{path}/moments"))
    return Bundle(load_model(f"{path}/model"), features, spark.read.parquet(f"{path}/moments") if kind == "scaled_pipeline" else None)
