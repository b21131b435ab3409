"""Result shaping: empty-column pruning (P4, A8, F28), vertical view (S10),
record export (S9, F26)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def empty_column_stats(df: DataFrame, substring: bool = True) -> DataFrame:
    """One row: per column, non-null count, null count and count of values
    that do not look like the "NA" placeholder.  One pass, partial
    aggregation; the result is tiny (3 numbers per column)."""
    aggs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        aggs += [F.count(c).alias(f"{f.name}__nn"), F.count_if(c.isNull()).alias(f"{f.name}__null")]
        if isinstance(f.dataType, T.StringType):
            na = c.contains("NA") if substring else (c == "NA")
            aggs.append(F.count_if(c.isNotNull() & ~na).alias(f"{f.name}__clean"))
        else:
            aggs.append(F.count(c).alias(f"{f.name}__clean"))
    return df.agg(*aggs)


def drop_empty_columns(df: DataFrame, substring: bool = True) -> DataFrame:
    """Drop a column when every value is null, or when it has no nulls
    and every value contains "NA" (``substring=False``: equals "NA").  An
    empty input drops every column.  Eager: runs one aggregate job."""
    stats = empty_column_stats(df, substring).first()
    keep = []
    for name in df.columns:
        nn, nulls, clean = stats[f"{name}__nn"], stats[f"{name}__null"], stats[f"{name}__clean"]
        if nn > 0 and (nulls > 0 or clean > 0):
            keep.append(name)
    return df.select(*[F.col(f"`{c}`") for c in keep])


def vertical_view(df: DataFrame, ids: list[str]) -> DataFrame:
    """Each row melted into (ids..., variable, value) with text values."""
    values = [c for c in df.columns if c not in ids]
    as_text = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in values])
    return as_text.unpivot(ids, values, "variable", "value")


def to_records(df: DataFrame, url_encoded: bool = False) -> DataFrame:
    """Each row as compact JSON text with all fields, nulls too
    (optionally URL-encoded)."""
    js = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select((F.url_encode(js) if url_encoded else js).alias("record"))
