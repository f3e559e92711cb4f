"""Raw text bars to a clean panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricecast.config import RAW_COLUMNS, SNAKE_NAMES, CleaningConfig
from pricecast.functions.text import percent_to_number, to_date, to_number, volume_to_number
from pricecast.operators.windows import fill_forward_back
from pricecast.sources.files import require_columns, trim_names

NUMERIC = ("price", "open", "high", "low", "vol", "change_pct")


def parse_bars(raw: DataFrame, cfg: CleaningConfig = CleaningConfig(), keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns beside ``series_id``, ``_seq`` and ``keep``; unreadable cells are NULL."""
    raw = require_columns(trim_names(raw), RAW_COLUMNS)
    parsed = {
        "Date": lambda c: to_date(c, cfg.date_formats),
        "Vol.": volume_to_number,
        "Change %": percent_to_number,
    }
    typed = [parsed.get(n, to_number)(F.col(f"`{n}`")).alias(SNAKE_NAMES[n]) for n in RAW_COLUMNS]
    return raw.select("series_id", "_seq", *keep, *typed)


def drop_unusable(parsed: DataFrame) -> DataFrame:
    return parsed.dropna(subset=["date", "price"])


def weekdays(df: DataFrame) -> DataFrame:
    return df.where(F.weekday("date") < 5)


def keep_last(df: DataFrame, columns: tuple[str, ...] = NUMERIC) -> DataFrame:
    """The row with the highest ``_seq`` of each series and date.

    An aggregate rather than a ranking: copies of one date are reduced before the shuffle, so a date repeated
    in a third of the input reaches its task as one row per map task. With a numeric ``_seq`` every part is of fixed
    width and the aggregate hashes; a struct ``_seq`` (rows of files) makes it sort.
    """
    return df.groupBy("series_id", "date").agg(*[F.max_by(c, "_seq").alias(c) for c in columns])


def clean_bars(raw: DataFrame, cfg: CleaningConfig = CleaningConfig()) -> DataFrame:
    """Parse, drop rows without date or price, keep weekdays, last row per date, volume 0, fill gaps.

    Weekend rows go before the fills and never feed them. The weekday test reads only the date, so it runs
    before the dedupe and saves its shuffle.
    """
    df = drop_unusable(parse_bars(raw, cfg))
    if cfg.keep_weekdays_only:
        df = weekdays(df)
    df = keep_last(df).withColumn("vol", F.coalesce("vol", F.lit(0.0)))
    return fill_forward_back(df, list(NUMERIC))


def cleaning_report(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Rows before and after per series, rows dropped, first and last date."""
    before = raw.groupBy("series_id").agg(F.count("*").alias("original_rows"))
    after = clean.groupBy("series_id").agg(
        F.count("*").alias("cleaned_rows"), F.min("date").alias("date_min"), F.max("date").alias("date_max")
    )
    return before.join(after, "series_id", "left").select(
        "series_id",
        "original_rows",
        F.coalesce("cleaned_rows", F.lit(0)).alias("cleaned_rows"),
        (F.col("original_rows") - F.coalesce("cleaned_rows", F.lit(0))).alias("dropped_rows"),
        "date_min",
        "date_max",
    )
