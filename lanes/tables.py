"""An export table derived by Spark from `lineitem` and `part`, and the same in SQL.

One cell per (part, return flag, line status, line number): analyte, replicate, label, fragment. A
part may have several lines per cell; they are aggregated. Traces are parabolas whose height, centre
and width come from the cell's lines, so scores vary and every line takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peakloom.functions.keys import add_ids
from peakloom.schema import ANALYTE, FRAGMENT, LABEL, REP
from peakloom.session import materialise

POINTS = 11


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cell_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_partkey", "l_returnflag", "l_linestatus", "l_linenumber"]
    return load(spark, sf_dir, "lineitem").groupBy(*keys).agg(
        F.round(F.sum("l_extendedprice"), 2).alias("area"),
        F.max("l_quantity").alias("lib"),
        F.round(F.avg("l_discount") * 140, 9).alias("err"),
        (F.sum("l_orderkey") % 5 - 2).alias("shift"),
        (F.sum("l_suppkey") % 3 + 2).alias("width"))


def export(spark: SparkSession, sf_dir: str, n_groups: int | None = 6) -> DataFrame:
    """The derived export with ids; traces as arrays `times`, `intens`, `mass_err`."""
    part = load(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_size", "p_type")
    cells = cell_table(spark, sf_dir).join(part, F.col("l_partkey") == F.col("p_partkey"))
    key, line = F.col("l_partkey"), F.col("l_linenumber")
    points = F.sequence(F.lit(0), F.lit(POINTS - 1))
    low = F.when(F.col("l_linestatus") == "F", 10.2).otherwise(10.3)
    single = key % 89 == 0

    def height(k: Column) -> Column:
        off = k - 5 - F.col("shift")
        return F.col("area") * F.greatest(
            F.lit(-0.05), 1 - (off * off) / (F.col("width") * F.col("width")))

    mass = F.col("p_size") * 10 + line * 7
    rows = cells.select(
        F.col("p_brand").alias("ProteinName"),
        F.concat("p_name", F.lit("-"), key.cast("string")).alias("PeptideModifiedSequence"),
        F.col("p_name").alias("ModifiedSequence"),
        F.col("l_linestatus").alias("IsotopeLabelType"),
        (F.col("p_type") == "ECONOMY").alias("IsDecoy"),
        (F.col("p_size") % 2 + 2).cast("bigint").alias("PrecursorCharge"),
        F.col("p_size").cast("double").alias("PrecursorMz"),
        (line % 2 + 1).cast("bigint").alias("ProductCharge"),
        # b ions (even lines) weigh the same in both labels, y ions do not
        F.when(line % 2 == 0, mass).when(F.col("l_linestatus") == "F", mass + 4)
        .otherwise(mass).cast("double").alias("ProductMz"),
        F.when(line == 7, "precursor [M+1]").when(line % 2 == 0, F.concat(F.lit("b"), line.cast("string")))
        .otherwise(F.concat(F.lit("y"), line.cast("string"))).alias("FragmentIon"),
        F.concat(F.lit("t/"), key.cast("string"), F.lit("/"), line.cast("string")).alias("TransitionLocator"),
        F.lit(True).alias("Quantitative"),
        F.concat(F.lit("run_"), F.col("l_returnflag"), F.lit(".raw")).alias("FileName"),
        F.lit(1.0).alias("LibraryDotProduct"),
        F.when(key % 97 != 0, F.when(single, 10.5).otherwise(low)).alias("MinStartTime"),
        F.when(key % 97 != 0, F.when(single, 10.5).otherwise(10.8)).alias("MaxEndTime"),
        F.col("area").alias("Area"), F.col("lib").alias("LibraryIntensity"),
        F.concat(F.lit("p/"), key.cast("string"), F.lit("/"), F.col("l_returnflag"), F.lit("/"),
                 F.col("l_linestatus")).alias("PrecursorResultLocator"),
        F.array(*[F.lit(round(10 + k * 0.1, 4)) for k in range(POINTS)]).alias("times"),
        F.transform(points, height).alias("intens"),
        F.transform(points, lambda k: F.col("err") * (1 + 0.1 * (k - 5))
                    * F.when(k % 2 == 1, -1).otherwise(1)).alias("mass_err"),
    )
    return add_ids(rows, n_groups)


def stored_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived export as a written table, for queries that scan it several times."""
    return materialise(export(spark, sf_dir), "export")


def wide_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traces of analytes with up to 14 fragments: a supplier's lines by line number and parity of the part."""
    side = F.col("l_partkey") % 2
    cells = load(spark, sf_dir, "lineitem").groupBy(
        "l_suppkey", "l_returnflag", "l_linestatus", (F.col("l_linenumber") * 2 + side).alias("signal")).agg(
        F.round(F.sum("l_extendedprice"), 2).alias("area"), F.max("l_quantity").alias("lib"),
        F.round(F.avg("l_discount") * 100, 9).alias("err"), (F.sum("l_orderkey") % 5 - 2).alias("shift"),
        (F.sum("l_partkey") % 3 + 2).alias("width"))
    points = F.sequence(F.lit(0), F.lit(POINTS - 1))

    def height(k: Column) -> Column:
        off = k - 5 - F.col("shift")
        return F.col("area") * (1 - (off * off) / (F.col("width") * F.col("width")))
    return materialise(cells.select(
        F.col("l_suppkey").cast("string").alias(ANALYTE), F.col("l_returnflag").alias(REP),
        F.col("l_linestatus").alias(LABEL), F.format_string("s%02d", "signal").alias(FRAGMENT),
        F.array(*[F.lit(round(10 + k * 0.1, 4)) for k in range(POINTS)]).alias("times"),
        F.transform(points, height).alias("intens"), F.transform(points, lambda k: F.col("err") + k * 0).alias("mass_err"),
        F.lit(10.2).alias("MinStartTime"), F.lit(10.8).alias("MaxEndTime"), F.col("area").alias("Area"),
        F.col("lib").alias("LibraryIntensity")), "wide-export")
