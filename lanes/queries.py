"""The registered queries. Each one runs an operator over whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanes import tables as tb
from lanes.tables import load
from peakloom import config as cfg
from peakloom.config import RefineParams
from peakloom.functions import keys as ks
from peakloom.functions import scores as sc
from peakloom.functions import traces as tr
from peakloom.operators import boundaries as bd
from peakloom.operators import cells as ce
from peakloom.operators import glossary as gl
from peakloom.operators import flip_search
from peakloom.operators import prefilter as pf
from peakloom.operators.quantiles import grouped_quantiles
from peakloom.operators import reports, scoring, search, selection
from peakloom.operators import similarity as si
from peakloom.plans import refine as rf
from peakloom.plans import resume
from peakloom.schema import (ANALYTE, CELL, EXPORT, EXPORT_HEADER, FRAGMENT, GLOSSARIES, GROUP, LABEL,
                             REP, RUN)
from peakloom.session import clustered, materialise, new_path, run_folder
from peakloom.sources import dataset, export, results
from peakloom.streaming import ingest

PARAMS = RefineParams()
# Lanes whose SQL climbs: file_to_report, refine_one_analyte, resumed_refinement.
CLIMB = RefineParams(exhaustive_limit=0)
Query = Callable[[SparkSession, str], DataFrame]


def r6(name: str | Column, alias: str | None = None) -> Column:
    """Round a double for comparison; adding zero turns -0.0 into 0.0."""
    col = F.col(name) if isinstance(name, str) else name
    return (F.round(col, 6) + F.lit(0.0)).alias(alias or name)


def back(name: str, alias: str) -> list[Column]:
    """A number's text read again: whether it is missing, and the number with all its digits."""
    return [(F.col(name) == "#N/A").alias(f"{alias}_na"), F.col(name).try_cast("double").alias(alias)]


# --- keys ------------------------------------------------------------------------------------------

def hash_key(spark, sf):
    key = F.concat_ws("_", F.col("l_partkey"), F.col("l_linenumber"))
    return load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber",
                                              ks.hash8(key).alias("key8"))


def salted_hash(spark, sf):
    name = F.col("c_name")
    return load(spark, sf, "customer").select(
        "c_custkey", ks.sha256_salted(name, "pepper").alias("text_salt"),
        ks.sha256_salted(name, b"pepper").alias("bytes_salt"), ks.hash8(name, "pepper").alias("short"))


def add_ids(spark, sf):
    return tb.export(spark, sf).select("TransitionLocator", "FileName", LABEL, ANALYTE, FRAGMENT, REP, GROUP)


def prefix_bucket(spark, sf):
    key = ks.hash8(F.col("l_orderkey"))
    return (load(spark, sf, "lineitem").select(ks.prefix_bucket(key, 6).alias("bucket"))
            .groupBy("bucket").agg(F.count("*").alias("n")))


def run_label_roundtrip(spark, sf):
    rows = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        ks.run_label(F.col("l_returnflag"), F.col("l_partkey").cast("string"), F.col("l_linestatus")).alias("run"))
    parts = ks.parse_run_label(F.translate("run", " ", "."))
    return rows.select("l_orderkey", "l_linenumber", "run",
                       *[part.alias(name.lower()) for name, part in parts.items()])


# --- glossaries ------------------------------------------------------------------------------------

def glossary_query(kind: str) -> Query:
    return lambda spark, sf: gl.glossary(tb.export(spark, sf), kind)


def glossary_merge(spark, sf):
    rows = tb.export(spark, sf)
    chunk = lambda label: gl.glossary(rows.filter(F.col(LABEL) == label), "locator")
    return gl.merge_glossary(chunk("F"), chunk("O"))


def id_collisions(spark, sf):
    key = F.concat_ws("_", F.col("l_partkey"), F.col("l_suppkey"))
    pairs = load(spark, sf, "lineitem").select(key.alias("original"), ks.hash8(key, width=4).alias("id"))
    return gl.id_collisions(pairs, "id")


# --- sources and sinks -----------------------------------------------------------------------------

def export_text(spark, sf) -> DataFrame:
    """The derived export as the text columns of an export file; `#N/A` for missing."""
    join = lambda name: F.array_join(F.transform(name, lambda v: v.cast("string")), ",")
    rows = tb.export(spark, sf, None).withColumns({
        "InterpolatedTimes": join("times"), "InterpolatedIntensities": join("intens"),
        "InterpolatedMassErrors": join("mass_err"), "IsDecoy": F.initcap(F.col("IsDecoy").cast("string"))})
    return rows.select(*[F.coalesce(F.col(name).cast("string"), F.lit("#N/A")).alias(header)
                         for name, header in zip(EXPORT.names, EXPORT_HEADER)])


def _written_export(spark, sf, name, change=lambda rows: rows) -> str:
    """A folder of export files. They are compressed: numbers as text take eleven times the room of the tables."""
    path = new_path(spark, name)
    (change(export_text(spark, sf)).write.option("header", True).option("compression", "gzip")
     .options(**export.QUOTED).csv(path))
    return path


EXPORT_VIEW = ["TransitionLocator", "FileName", LABEL, "IsDecoy", "PrecursorCharge", "ProductMz",
               "MinStartTime", "Area", "LibraryIntensity"]


def csv_roundtrip(spark, sf):
    rows = export.read_export(spark, _written_export(spark, sf, "csv"))
    total = F.aggregate(F.transform(tr.parse_trace(F.col("InterpolatedMassErrors")), F.abs), F.lit(0.0),
                        lambda acc, e: acc + e)
    return rows.select(*EXPORT_VIEW, r6(total, "abs_error"))


def csv_quotes(spark, sf):
    """Names with quotes and commas, read back by the batch and the stream reader."""
    odd = F.concat(F.lit('"a ""b'), F.col("Modified Sequence"), F.lit('", c\\'))
    path = _written_export(spark, sf, "quotes", lambda rows: rows.withColumn("Modified Sequence", odd))
    columns = ["TransitionLocator", "ModifiedSequence", "FileName", LABEL]
    batch = export.read_export(spark, path).select(F.lit("batch").alias("reader"), *columns)
    rows = ingest.stream_export(spark, path).select(F.lit("stream").alias("reader"), *columns, GROUP)
    dst = new_path(spark, "quotes-out")
    ingest.stream_ingest(rows, dst, new_path(spark, "progress")).awaitTermination()
    return batch.unionByName(spark.read.schema(rows.schema).parquet(dst).drop(GROUP))


def parquet_roundtrip(spark, sf):
    path = new_path(spark, "orders")
    export.csv_to_parquet(load(spark, sf, "orders"), path)
    orders = dataset.read_table(spark, path)
    return orders.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def _indexed(spark, sf):
    rows = tb.export(spark, sf).select(*CELL, GROUP, "TransitionLocator", "Area")
    path = new_path(spark, "indexed")
    dataset.write_indexed(rows, path)
    return path, rows.schema


def partition_write(spark, sf):
    path, schema = _indexed(spark, sf)
    return dataset.read_partition(spark, path, schema)


def _layout(*by: str) -> Query:
    """Written twice with these directory levels, read back: the second write replaces the first."""
    def query(spark, sf):
        rows = tb.stored_export(spark, sf).select(*CELL, GROUP, "TransitionLocator", "Area")
        path = new_path(spark, "layout")
        for _ in range(2):
            dataset.write_indexed(rows, path, by)
        return dataset.read_partition(spark, path, rows.schema)
    return query


def analyte_csv_export(spark, sf):
    rows = tb.stored_export(spark, sf).select(*CELL, GROUP, "TransitionLocator", "Area")
    path = new_path(spark, "csv-by-analyte")
    dataset.export_all_csv(rows, path, ANALYTE, glossary=gl.glossary(tb.export(spark, sf), "analyte"))
    return dataset.read_exported_csv(spark, path, rows.schema)


def partition_read(spark, sf):
    path, schema = _indexed(spark, sf)
    return dataset.read_partition(spark, path, schema, [ANALYTE, FRAGMENT, "Area"], ID_group=3)


def partition_csv_export(spark, sf):
    rows = tb.export(spark, sf).select(*CELL, GROUP, "TransitionLocator", "Area")
    path = new_path(spark, "csv-by-group")
    dataset.export_all_csv(rows, path, GROUP, glossary=gl.glossary(tb.export(spark, sf), "analyte_group"))
    return dataset.read_exported_csv(spark, path, rows.schema)


def results_read(spark, sf):
    path = new_path(spark, "results")
    kept = gl.glossary(tb.export(spark, sf), "locator").select(FRAGMENT, ANALYTE).distinct()
    for _ in range(2):  # the second write replaces the first
        results.write_results(kept, path, "Transitions")
    return results.read_results(spark, path, "Transitions")


def na_coerce(spark, sf):
    rows = load(spark, sf, "events").select("event_id", "event_type", F.col("props").alias("text"),
                                            F.col("value").cast("string").alias("value"))
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()),
                           T.StructField("text", T.LongType()), T.StructField("value", T.DoubleType())])
    return export.coerce_types(rows, schema, ("error",))


def na_text(spark, sf):
    value = F.when(F.col("event_type") != "error", F.col("value"))
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    text = load(spark, sf, "events").select("event_id", sc.na_text(value).alias("t"),
                                            sc.na_text(kind, numeric=False).alias("kind_text"))
    return text.select("event_id", *back("t", "value"), "kind_text")


# --- traces ----------------------------------------------------------------------------------------

def _vectors(spark, sf):
    return load(spark, sf, "embeddings").select(
        "vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("v"))


def trace_parse(spark, sf):
    text = _vectors(spark, sf).select("vec_id", F.array_join(
        F.transform("v", lambda v: v.cast("string")), " , ").alias("text"))
    return text.select("vec_id", F.posexplode(tr.parse_trace(F.col("text"))).alias("pos", "value"))


def trace_clamp(spark, sf):
    clean = tr.clamp_nonneg(tr.nan_to_zero(F.col("v")))
    return _vectors(spark, sf).select("vec_id", F.posexplode(clean).alias("pos", "value"))


def trace_normalise(spark, sf):
    scaled = tr.normalise_trace(tr.clamp_nonneg(F.col("v")))
    return _vectors(spark, sf).select("vec_id", F.posexplode(scaled).alias("pos", "value")).select(
        "vec_id", "pos", r6("value"))


def integration_zone(spark, sf):
    runs = clustered(tb.export(spark, sf).select(*rf.TRACE_COLUMNS), "traces", RUN)
    zones = ce.run_zones(ce.zoned_rows(runs)).filter(F.col("reason") == ce.OK)
    return zones.select(*RUN, F.posexplode("zone").alias("pos", "z"))


def quarantine(spark, sf):
    return ce.quarantine(materialise(ce.build_cells(tb.stored_export(spark, sf), PARAMS), "cells"))


def cut_normalise(spark, sf):
    cells = ce.build_cells(tb.stored_export(spark, sf), PARAMS)
    return (cells.select(*CELL, F.posexplode("x").alias("pos", "value"))
            .select(*CELL, "pos", r6("value")))


# --- filters ---------------------------------------------------------------------------------------

def ion_filter(spark, sf):
    return pf.drop_low_ordinal(tb.export(spark, sf), 3).select(*CELL)


def unintegrated_filter(spark, sf):
    return pf.drop_unintegrated(tb.export(spark, sf)).select(*CELL)


def label_complete(spark, sf):
    return pf.require_all_labels(tb.export(spark, sf)).select(*CELL)


def shared_signal(spark, sf):
    return pf.drop_shared_signals(tb.export(spark, sf)).select(*CELL)


def min_fragments(spark, sf):
    return pf.require_min_fragments(tb.export(spark, sf), 6).select(*CELL)


def prefilter(spark, sf):
    return pf.prefilter(tb.export(spark, sf), RefineParams(remove_below_ordinal=1, min_initial_fragments=4)).select(*CELL)


# --- scores ----------------------------------------------------------------------------------------

def _cells(spark, sf):
    # the traces are read once, so they are not written first
    return ce.usable_cells(materialise(ce.build_cells(tb.export(spark, sf), PARAMS), "cells"))


def mass_error_score(spark, sf):
    return ce.build_cells(tb.stored_export(spark, sf), PARAMS).filter(F.col("reason") == ce.OK).select(
        *CELL, r6("mean_err"), r6("err_score"))


def median_error_filter(spark, sf):
    rows = _cells(spark, sf).withColumn("similarity", F.lit(None).cast("double"))
    table = selection.fragment_quartiles(rows)
    return table.filter(F.col("median_error") >= PARAMS.mass_error_cutoff).select(
        ANALYTE, FRAGMENT, r6("median_error"))


def hot_quantiles(spark, sf):
    """Groups of which each holds a large share of the rows."""
    rows = load(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice", (
        F.col("l_discount") - F.col("l_tax")).alias("net"))
    return grouped_quantiles(rows, ["l_returnflag", "l_linestatus"], {
        "price_q1": ("l_extendedprice", 0.25), "price_median": ("l_extendedprice", 0.5), "net_median": ("net", 0.5),
        "net_q99": ("net", 0.99)}, hot_rows=500).select(
        "l_returnflag", "l_linestatus", *[r6(c) for c in ("price_q1", "price_median", "net_median", "net_q99")])


def mean_area(spark, sf):
    return ce.mean_area_profile(tb.export(spark, sf)).select(ANALYTE, LABEL, FRAGMENT, r6("mean_area"))


def total_to_max(spark, sf):
    return ce.total_to_max(tb.export(spark, sf)).select(*RUN, r6("sum_area"), r6("max_area"), r6("total_to_max"))


def _lines(spark, sf):
    """Cells of `lineitem` under the domain names, fragments named by their line number."""
    return tb.cell_table(spark, sf).select(
        F.col("l_partkey").cast("string").alias(ANALYTE), F.col("l_returnflag").alias(REP),
        F.col("l_linestatus").alias(LABEL), F.concat(F.lit("y"), F.col("l_linenumber").cast("string")).alias(FRAGMENT),
        F.col("area").alias("Area"))


FRAGMENTS = [f"y{line}" for line in range(1, 8)]


def area_pivot(spark, sf):
    return ce.pivot_area(_lines(spark, sf), FRAGMENTS)


def area_unpivot(spark, sf):
    return ce.unpivot_scores(area_pivot(spark, sf), RUN, FRAGMENTS, "fragment", "area")


def library_rank(spark, sf):
    return ce.library_rank(tb.export(spark, sf)).select(ANALYTE, FRAGMENT, "lib", F.col("Rank").alias("rank"))


def similarity_events(spark, sf):
    hours = load(spark, sf, "events").select("user_id", "event_type", F.date_trunc("hour", "ts").alias("hour"), "value")
    return si.similarity(hours.groupBy("user_id", "event_type", "hour").agg(F.sum("value").alias("value")),
                         ["user_id"], "event_type", "hour", "value").select(
        "user_id", "event_type", r6("similarity"))


def similarity_vectors(spark, sf):
    points = load(spark, sf, "embeddings").select(
        "label", "vec_id", F.posexplode("embedding").alias("pos", "value")).select(
        "label", "vec_id", "pos", F.greatest(F.col("value").cast("double"), F.lit(0.0)).alias("value"))
    return si.similarity(points, ["label"], "vec_id", "pos", "value").select("label", "vec_id", r6("similarity"))


def similarity_traces(spark, sf):
    return si.cell_similarity(_cells(spark, sf)).select(*CELL, r6("similarity"))


def _initial_rows(traces):
    prep = rf.prepare(traces, PARAMS)
    return prep, materialise(rf.full_set_rows(prep, F.lit(cfg.STAGE_INITIAL)), "rows")


SCORES = ["SimilarityScore", "MPRAScore", "Librarydotp", "IntensityScore", "ScoreMassError"]


def _rounded(df, keys):
    return df.select(*keys, *[r6(name) for name in SCORES])


def score_replicates(spark, sf):
    _, rows = _initial_rows(tb.stored_export(spark, sf))
    return _rounded(scoring.score_replicates(rows), [*RUN, "Comment"])


def score_transitions(spark, sf):
    _, rows = _initial_rows(tb.stored_export(spark, sf))
    return scoring.score_transitions(rows).select(*CELL, r6("similarity"))


def fragment_classifier(spark, sf):
    prep, rows = _initial_rows(tb.stored_export(spark, sf))
    table = selection.classify(rows, prep.library)
    return table.select(ANALYTE, FRAGMENT, "rank_similarity", "rank_area", F.col("Rank").alias("rank_library"),
                        r6("q25_similarity"), r6("q25_area"), r6("median_error"))


def worst_n(spark, sf):
    prep, rows = _initial_rows(tb.stored_export(spark, sf))
    return selection.worst_n(selection.classify(rows, prep.library), PARAMS)


def subset_search(spark, sf):
    prep, rows = _initial_rows(tb.stored_export(spark, sf))
    everything = selection.placed(selection.classify(rows, prep.library))
    found = search.search_subsets(prep.grams, search.proposals(everything, prep.fragments), PARAMS)
    names = search.mask_fragments(found, prep.fragments, "solution")
    return names.join(found.select(ANALYTE, r6("fitness")), ANALYTE)


def _wide(spark, sf, params):
    prep = rf.prepare(tb.wide_export(spark, sf), params)
    rows = materialise(rf.full_set_rows(prep, F.lit(cfg.STAGE_INITIAL)), "rows")
    return prep, selection.placed(selection.classify(rows, prep.library))


def wide_search(spark, sf):
    """Up to 14 fragments, climbed from run matrices."""
    prep, everything = _wide(spark, sf, PARAMS)
    found = search.search_subsets(prep.grams, search.proposals(everything, prep.fragments), PARAMS)
    names = search.mask_fragments(found, prep.fragments, "solution")
    return names.join(found.select(ANALYTE, r6("fitness")), ANALYTE)


def wide_search_long(spark, sf):
    """The same in long form, as for analytes of any size."""
    params = RefineParams(list_limit=0)
    prep, everything = _wide(spark, sf, params)
    starts = flip_search.starts(everything, None, params.min_fragments)
    return flip_search.flip_search(prep.large, prep.refs, starts, params)


def score_replicates_long(spark, sf):
    """Replicate scores from long rows, as for analytes of any size."""
    prep = rf.prepare(tb.stored_export(spark, sf), RefineParams(list_limit=0))
    rows = materialise(rf.full_set_rows(prep, F.lit(cfg.STAGE_INITIAL)), "rows")
    return _rounded(scoring.score_replicates(rows), [*RUN, "Comment"])


def _selection(spark, sf, traces=None):
    with run_folder(spark, "selection"):
        return rf.refine_transitions(rf.prepare(tb.stored_export(spark, sf) if traces is None else traces, PARAMS), PARAMS)


def refine_transitions(spark, sf):
    return _selection(spark, sf).transitions


def stage_union(spark, sf):
    return _rounded(_selection(spark, sf).replicates, [*RUN, "Comment"])


# --- boundaries, rescoring, reports ----------------------------------------------------------------

def peak_island(spark, sf):
    points = load(spark, sf, "events").select("user_id", "ts", "value", (F.col("event_type") != "error").alias("zone"))
    island = bd.peak_island(points, ["user_id"], "ts", "value", "zone", 0.25)
    text = lambda name: F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return island.select("user_id", text("left").alias("left_ts"), text("right").alias("right_ts"),
                         text("apex_time").alias("apex_ts"), r6("apex"))


def refine_boundaries(spark, sf):
    rows = clustered(tb.export(spark, sf).select(*rf.TRACE_COLUMNS), "traces", RUN)
    zones = materialise(ce.run_zones(ce.zoned_rows(rows)), "zones")
    summed = bd.replicate_traces(rows, rows.select(ANALYTE, FRAGMENT).distinct(), zones)
    return bd.refine_boundaries(summed, PARAMS.edge_fraction).select(
        ANALYTE, REP, r6("MinStartTime"), r6("MaxEndTime"))


def refine_global_boundaries(spark, sf):
    return rf.refine_global(tb.stored_export(spark, sf), PARAMS).boundaries.select(ANALYTE, REP, r6("MinStartTime"), r6("MaxEndTime"))


def rescore(spark, sf):
    return _rounded(rf.refine_global(tb.stored_export(spark, sf), PARAMS).rescore, [*RUN, "Comment"])


def _glossaries(rows):
    return gl.glossary(rows, "analyte"), gl.glossary(rows, "rep")


def report_boundaries(spark, sf):
    rows = tb.stored_export(spark, sf)
    limits = rf.refine_global(rows, PARAMS).boundaries
    table = reports.report_boundaries(limits, *_glossaries(rows))
    return table.select("FileName", "PeptideModifiedSequence", *back("MinStartTime", "start"),
                        *back("MaxEndTime", "end"), "PrecursorCharge", "PrecursorIsDecoy")


def report_transitions(spark, sf):
    rows = tb.stored_export(spark, sf)
    kept = _selection(spark, sf, rows).transitions
    return reports.report_transitions(kept, gl.glossary(rows, "locator"))


META = ["ProteinName", "PeptideModifiedSequence", "PrecursorCharge", "IsDecoy", "FileName"]


def report_replicates(spark, sf):
    traces = tb.stored_export(spark, sf)
    scores = _selection(spark, sf, traces).replicates
    table = reports.report_replicates(scores, *_glossaries(traces))
    return table.select(*RUN, "Comment", *META, *[r6(name) for name in [*SCORES, "Skor"]])


def report_rescore(spark, sf):
    traces = tb.stored_export(spark, sf)
    table = reports.report_rescore(rf.refine_global(traces, PARAMS).rescore, *_glossaries(traces))
    return table.select(*RUN, "Comment", *META, *[r6(name) for name in [*SCORES, "Skor"]])


def report_annotations(spark, sf):
    traces = tb.stored_export(spark, sf)
    table = reports.report_annotations(rf.refine_global(traces, PARAMS).rescore, *_glossaries(traces),
                                       gl.glossary(traces, "precursor"))
    return _annotation_values(table)


def _annotation_values(table):
    """The text form of the report as numbers again."""
    return table.select("ElementLocator", *[r6(F.col(name).try_cast("double"), name)
                                            for name in table.columns if name != "ElementLocator"])


def run_account(spark, sf):
    """Every run once, rescored or with a reason; duplicates, missing labels and silent runs included."""
    rows = tb.stored_export(spark, sf)
    odd = rows.filter((F.col(LABEL) == "F") & (F.substring(ANALYTE, 1, 1) < "8"))
    nameless = odd.withColumn(LABEL, F.lit(None).cast("string"))
    silent = odd.withColumns({LABEL: F.lit("silent"), "intens": F.transform("intens", lambda _: F.lit(0.0))})
    ragged = odd.withColumns({LABEL: F.lit("ragged"), "mass_err": F.slice("mass_err", 1, 5)})
    clash = odd.withColumn(LABEL, F.lit("clash"))
    clash = clash.unionByName(clash.withColumn("Area", F.col("Area") + 1))
    every = rows.unionByName(odd)
    for part in (nameless, silent, ragged, clash):
        every = every.unionByName(part)
    done = rf.refine_global(materialise(every, "odd-export"), PARAMS)
    scored = done.rescore.select(*RUN, F.lit(True).alias("_scored")).distinct()
    # told: called rescored exactly if the run has rescored values
    told = (F.col("reason") == rf.RESCORED) == F.coalesce("_scored", F.lit(False))
    return done.account.join(scored, RUN, "left").groupBy(*RUN).agg(
        F.count("*").alias("times"), F.min(F.coalesce(told, F.lit(False))).alias("told"),
        F.min(F.when(F.col(LABEL).isin("ragged", "clash"), F.col("reason"))).alias("reason"))


def _cells_of(report: str, table: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """A report read back from its file, as rows (report, key, name, missing, value)."""
    named = F.array(*[F.struct(F.lit(v).alias("name"), F.col(v).alias("text")) for v in values])
    key = F.concat_ws("|", *keys) if keys else F.lit("")
    return table.select(F.lit(report).alias("report"), key.alias("key"), F.explode(named).alias("v")).select(
        "report", "key", "v.name", F.coalesce(F.col("v.text").isin("#N/A", "NA"), F.lit(True)).alias("missing"),
        r6(F.coalesce(F.col("v.text").try_cast("double"), F.col("v.text").try_cast("boolean").cast("double")), "value"))


def file_to_report(spark, sf):
    """From the export file to all five reports: ids, dataset, refinement, committed result files of all four
    kinds, the report files, every number of them read back."""
    rows = gl.split_ids(ks.add_ids(export.with_traces(export.read_export(
        spark, _written_export(spark, sf, "export"))), PARAMS.n_groups))
    gl.check_ids(rows)
    path, out = new_path(spark, "indexed"), new_path(spark, "results")
    dataset.write_indexed(rows, path)
    traces = dataset.read_partition(spark, path, rows.schema)
    done = rf.refine_global(traces, CLIMB)
    for kind, table in (("PeakBoundaries", done.boundaries), ("Transitions", done.transitions),
                        ("Replicate", done.replicates), ("ReScore", done.rescore)):
        results.write_results(table, out, kind)
    read = lambda kind: results.read_results(spark, out, kind)
    names, analytes = _glossaries(traces), gl.glossary(traces, "analyte")
    files = new_path(spark, "reports")
    for name, table in (
            ("boundaries", reports.report_boundaries(read("PeakBoundaries"), *names)),
            ("transitions", reports.report_transitions(read("Transitions"), gl.glossary(traces, "locator"))),
            ("replicates", reports.report_replicates(read("Replicate"), *names)),
            ("rescore", reports.report_rescore(read("ReScore"), *names)),
            ("annotations", reports.report_annotations(read("ReScore"), *names, gl.glossary(traces, "precursor")))):
        results.write_report(table, files, name, analytes)
    text = lambda name: results.read_report(spark, files, name)
    scores, run = [*SCORES, "Skor"], [*RUN, "Comment", "FileName", "PeptideModifiedSequence"]
    marks = [f"annotation_{c}" for c in ("Similarity_Score", "MPRA_Score", "SpectralLibSim_Score", "MassError_Score", "Score")]
    tables = [
        _cells_of("boundaries", text("boundaries"), ["FileName", "PeptideModifiedSequence", "PrecursorCharge", "PrecursorIsDecoy"],
                  ["MinStartTime", "MaxEndTime"]),
        _cells_of("transitions", text("transitions"), ["ElementLocator"], ["Quantitative"]),
        _cells_of("replicates", text("replicates"), run, scores), _cells_of("rescore", text("rescore"), run, scores),
        _cells_of("annotations", text("annotations"), ["ElementLocator"], marks),
        _cells_of("completed", text("completed_analytes"), [ANALYTE], ["PrecursorCharge"])]
    return reduce(DataFrame.unionByName, tables)


def refine_one_analyte(spark, sf):
    """The first analyte through the whole plan, read by its directory."""
    rows = tb.stored_export(spark, sf).select(*rf.TRACE_COLUMNS, GROUP)
    path = new_path(spark, "by-analyte")
    dataset.write_indexed(rows, path, (GROUP, ANALYTE))
    first = rows.filter(F.col("MinStartTime").isNotNull()).agg(F.min(F.struct(GROUP, ANALYTE))).first()[0]
    one = dataset.read_partition(spark, path, rows.schema, **{GROUP: first[GROUP], ANALYTE: first[ANALYTE]})
    return _rounded(rf.refine_global(one, CLIMB).rescore, [*RUN, "Comment"])


def resumed_refinement(spark, sf):
    """Half of the rows first, then all of them with one change: what changed is refined, the results are those of
    a full run. `refined` counts the analytes of the three runs."""
    rows, path = tb.stored_export(spark, sf), new_path(spark, "resumed")
    early = rows.filter(F.col(GROUP) <= 3)
    counts = [resume.refine_resumable(part, CLIMB, path) for part in (early, rows, rows)]
    table = results.read_results(spark, path, "ReScore")
    return _rounded(table, [*RUN, "Comment"]).withColumn("refined", F.lit("/".join(map(str, counts))))


def one_analyte_csv(spark, sf):
    """The first analyte's rows as CSV in a folder of its name, read back."""
    rows = tb.stored_export(spark, sf).select(*CELL, GROUP, "TransitionLocator", "Area")
    path, first = new_path(spark, "one-csv"), rows.agg(F.min(ANALYTE)).first()[0]
    dataset.export_partition_csv(rows, path, ANALYTE, first)
    return dataset.read_exported_csv(spark, f"{path}/data_analyte_{first}", rows.schema)


# --- streaming -------------------------------------------------------------------------------------

def stream_ingest(spark, sf):
    src, dst = _written_export(spark, sf, "arriving"), new_path(spark, "ingested")
    rows = ingest.stream_export(spark, src).select(*CELL, GROUP, "TransitionLocator", "Area")
    ingest.stream_ingest(rows, dst, new_path(spark, "progress")).awaitTermination()
    return dataset.read_partition(spark, dst, rows.schema)


def stream_ingest_files(spark, sf):
    """The careful ingest: a file with a foreign header and a torn line are listed, all else arrives, and a batch
    played again adds nothing."""
    src, dst = _written_export(spark, sf, "arriving"), new_path(spark, "ingested")
    torn = spark.createDataFrame([(",".join(EXPORT_HEADER),), ("only,three,fields",)], "value string")
    torn.coalesce(1).write.text(f"{src}/torn")
    spark.createDataFrame([("another,header",), ("1,2",)], "value string").coalesce(1).write.text(f"{src}/foreign")
    files = sorted(r["path"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", True)
                   .option("pathGlobFilter", "part-*").load(src).select("path").collect())
    middle = len(files) // 2
    for batch, part in (("0", files[:middle]), ("1", files[middle:]), ("0", files[:middle])):
        ingest.ingest_batch(spark, part, batch, dst)
    kind = ks.add_ids(export.coerce_types(spark.createDataFrame([], EXPORT), EXPORT), 6).schema
    rows = ingest.read_ingested(spark, dst, kind).select(*CELL, GROUP, "TransitionLocator", "Area")
    rejected = ingest.read_rejects(spark, dst).agg(F.array_join(F.sort_array(F.collect_list("reason")), ", ").alias("rejected"))
    told = rejected.first()["rejected"]
    return rows.withColumn("rejected", F.lit(told))


def stream_glossary(spark, sf):
    src, dst = _written_export(spark, sf, "arriving"), new_path(spark, "glossary")
    rows = ingest.stream_export(spark, src)
    ingest.stream_glossary(rows, "locator", dst, new_path(spark, "progress")).awaitTermination()
    return spark.read.schema(rows.select(*GLOSSARIES["locator"]).schema).parquet(dst)


QUERIES: dict[str, Query] = {
    "hash_key": hash_key,
    "salted_hash": salted_hash,
    "add_ids": add_ids,
    "prefix_bucket": prefix_bucket,
    "run_label_roundtrip": run_label_roundtrip,
    **{f"glossary_{kind}": glossary_query(kind) for kind in GLOSSARIES},
    "glossary_merge": glossary_merge,
    "id_collisions": id_collisions,
    "csv_roundtrip": csv_roundtrip,
    "csv_quotes": csv_quotes,
    "parquet_roundtrip": parquet_roundtrip,
    "partition_write": partition_write,
    "layout_analyte": _layout(ANALYTE),
    "layout_group_analyte": _layout(GROUP, ANALYTE),
    "analyte_csv_export": analyte_csv_export,
    "partition_read": partition_read,
    "partition_csv_export": partition_csv_export,
    "results_read": results_read,
    "na_coerce": na_coerce,
    "na_text": na_text,
    "trace_parse": trace_parse,
    "trace_clamp": trace_clamp,
    "trace_normalise": trace_normalise,
    "integration_zone": integration_zone,
    "quarantine": quarantine,
    "cut_normalise": cut_normalise,
    "unintegrated_filter": unintegrated_filter,
    "ion_filter": ion_filter,
    "label_complete": label_complete,
    "shared_signal": shared_signal,
    "min_fragments": min_fragments,
    "prefilter": prefilter,
    "mass_error_score": mass_error_score,
    "median_error_filter": median_error_filter,
    "hot_quantiles": hot_quantiles,
    "mean_area": mean_area,
    "total_to_max": total_to_max,
    "area_pivot": area_pivot,
    "area_unpivot": area_unpivot,
    "library_rank": library_rank,
    "similarity_events": similarity_events,
    "similarity_vectors": similarity_vectors,
    "similarity_traces": similarity_traces,
    "score_replicates": score_replicates,
    "score_transitions": score_transitions,
    "fragment_classifier": fragment_classifier,
    "worst_n": worst_n,
    "subset_search": subset_search,
    "wide_search": wide_search,
    "wide_search_long": wide_search_long,
    "score_replicates_long": score_replicates_long,
    "refine_transitions": refine_transitions,
    "stage_union": stage_union,
    "peak_island": peak_island,
    "refine_boundaries": refine_boundaries,
    "refine_global_boundaries": refine_global_boundaries,
    "rescore": rescore,
    "report_boundaries": report_boundaries,
    "report_transitions": report_transitions,
    "report_replicates": report_replicates,
    "report_rescore": report_rescore,
    "report_annotations": report_annotations,
    "run_account": run_account,
    "file_to_report": file_to_report,
    "refine_one_analyte": refine_one_analyte,
    "resumed_refinement": resumed_refinement,
    "one_analyte_csv": one_analyte_csv,
    "stream_ingest": stream_ingest,
    "stream_ingest_files": stream_ingest_files,
    "stream_glossary": stream_glossary,
}
