"""Maps and nested reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricecast.functions.text import to_number


def map_problem(m: Column, expected: list[str]) -> Column:
    """Why a ``map<string,string>`` of features is refused, or NULL. Missing, then extra, then not numeric."""
    names = F.array(*[F.lit(n) for n in expected])
    missing = F.array_except(names, F.map_keys(m))
    extra = F.array_except(F.map_keys(m), names)
    wordy = F.filter(names, lambda n: to_number(F.element_at(m, n)).isNull())
    listed = lambda label, a: F.concat(F.lit(label + ": "), F.array_join(F.array_sort(a), ","))
    return (
        F.when(m.isNull(), F.lit("missing: all"))
        .when(F.size(missing) > 0, listed("missing", missing))
        .when(F.size(extra) > 0, listed("extra", extra))
        .when(F.size(wordy) > 0, listed("not numeric", wordy))
    )


def map_to_array(m: Column, expected: list[str]) -> Column:
    """Values as doubles in the model's own order."""
    return F.array(*[to_number(F.element_at(m, F.lit(n))) for n in expected])


def numeric_leaves(df: DataFrame, prefix: str = "") -> list[tuple[str, Column]]:
    """Dotted name and column of every numeric or boolean leaf of a nested schema; text leaves are skipped."""
    out: list[tuple[str, Column]] = []

    def walk(fields, base: str, path: str) -> None:
        for f in fields:
            name, ref = f"{path}{f.name}", f"{base}`{f.name}`"
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType.fields, ref + ".", name + ".")
            elif isinstance(f.dataType, (T.NumericType, T.BooleanType)):
                c = F.col(ref)
                if isinstance(f.dataType, T.BooleanType):
                    c = c.cast("int")
                out.append((name, c.cast("double")))

    walk(df.schema.fields, "", prefix)
    return out


def flatten_metrics(df: DataFrame, keys: list[str], prefix: str = "") -> DataFrame:
    """Nested numeric report columns to ``(keys, metric, value)`` rows, NULL leaves dropped."""
    leaves = numeric_leaves(df.drop(*keys), prefix)
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), c.alias("value")) for n, c in leaves]))
    return (
        df.select(*keys, pairs.alias("leaf"))
        .select(*keys, "leaf.metric", "leaf.value")
        .where(F.col("value").isNotNull())
    )
