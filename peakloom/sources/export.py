"""The export file: scan, typed coercion, columnar copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakloom.functions.traces import parse_trace
from peakloom.schema import EXPORT, EXPORT_HEADER, NA_TOKENS


# A quote inside a quoted field is doubled.
QUOTED = {"quote": '"', "escape": '"'}


def normalise_names(df: DataFrame) -> DataFrame:
    """Drop dots, then blanks, from every column name."""
    return df.toDF(*[name.replace(".", "").replace(" ", "") for name in df.columns])


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])


def coerce_types(df: DataFrame, schema: T.StructType,
                 na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Missing tokens to null, then every column of `schema` cast; a value that does not parse is
    null. Columns outside the schema are dropped."""
    def typed(field: T.StructField):
        col = F.col(field.name)
        if field.name in df.columns and df.schema[field.name].dataType == T.StringType():
            # the trace strings are comma lists, so a token can only be the whole field
            col = F.when(~col.isin(list(na_tokens)), col)
        if field.dataType == T.StringType():
            return col.cast("string").alias(field.name)
        if field.dataType == T.LongType():
            # an integer column exported with gaps is often printed as 2.0; 2.7 is no integer
            whole = col.try_cast("decimal(38,6)")
            return F.coalesce(col.try_cast("bigint"),
                              F.when(whole == F.floor(whole), whole.try_cast("bigint"))).alias(field.name)
        return col.try_cast(field.dataType).alias(field.name)

    return df.select(*[typed(field) for field in schema.fields])


def read_export(spark: SparkSession, path: str, header: Sequence[str] = EXPORT_HEADER,
                schema: T.StructType = EXPORT) -> DataFrame:
    """Scan an export CSV (file, folder or glob) and type it; input splits bound the memory."""
    raw = (spark.read.schema(text_schema(header)).option("header", True)
           .option("enforceSchema", False).options(**QUOTED).csv(path))
    return coerce_types(normalise_names(raw), schema)


def csv_to_parquet(df: DataFrame, path: str) -> None:
    """One snappy Parquet table with the schema of `df`."""
    df.write.option("compression", "snappy").parquet(path)


def with_traces(df: DataFrame) -> DataFrame:
    """Replace the three trace strings by arrays: `times`, `intens`, `mass_err`."""
    return df.withColumns({
        "times": parse_trace(F.col("InterpolatedTimes")),
        "intens": parse_trace(F.col("InterpolatedIntensities")),
        "mass_err": parse_trace(F.col("InterpolatedMassErrors")),
    }).drop("InterpolatedTimes", "InterpolatedIntensities", "InterpolatedMassErrors")
