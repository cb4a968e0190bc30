import pytest
from pyspark.sql import functions as F

from peakloom.functions.keys import add_ids
from peakloom.operators import glossary
from peakloom.schema import ANALYTE, EXPORT, EXPORT_HEADER, FRAGMENT, GROUP, LABEL, REP, RESULTS
from peakloom.sources import dataset, export, results
from peakloom.streaming import ingest

LINE = ["P1", "PEPTIDE", "PEPTIDE", "light", "False", "2", "400.5", "1", "500.25", "y5", "t/1", "True", "run1.raw",
        "#N/A", "10.1", "10.3", "500", "8", "10.0,10.1,10.2", "1,NaN,3", "0,#N/A,2", "p/1"]


@pytest.fixture
def folder(tmp_path):
    lines = [LINE, [*LINE[:5], "2.0", *LINE[6:9], "y6", "t/2", *LINE[11:14], "#N/A", *LINE[15:]]]
    text = [",".join(EXPORT_HEADER)] + [",".join(f'"{v}"' if "," in v else v for v in line) for line in lines]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join(text) + "\n")
    (tmp_path / "in" / "b.csv").write_text("\n".join(text) + "\n")
    return tmp_path


def test_read_export(spark, folder):
    df = export.read_export(spark, str(folder / "in" / "a.csv"))
    assert df.schema == EXPORT
    rows = {r.FragmentIon: r for r in df.collect()}
    assert rows["y5"].LibraryDotProduct is None and rows["y5"].IsDecoy is False
    assert rows["y6"].PrecursorCharge == 2 and rows["y6"].MinStartTime is None
    trace = export.with_traces(df).filter("FragmentIon = 'y5'").first()
    assert trace.mass_err == [0.0, None, 2.0] and trace.times == [10.0, 10.1, 10.2]
    assert trace.intens[1] != trace.intens[1]


def test_doubled_quotes_and_fractions(spark, folder):
    odd = [*LINE[:1], 'PEP"T,IDE', *LINE[2:5], "2.7", *LINE[6:]]
    text = ",".join(EXPORT_HEADER) + "\n" + ",".join('"' + v.replace('"', '""') + '"' for v in odd) + "\n"
    (folder / "odd").mkdir()
    (folder / "odd" / "a.csv").write_text(text)
    row = export.read_export(spark, str(folder / "odd")).first()
    assert row.PeptideModifiedSequence == 'PEP"T,IDE' and row.FileName == "run1.raw" and row.PrecursorCharge is None


@pytest.mark.parametrize("stream", [False, True])
def test_a_reordered_header_fails(spark, folder, stream):
    (folder / "bad").mkdir()
    (folder / "bad" / "a.csv").write_text(",".join(reversed(EXPORT_HEADER)) + "\n" + ",".join(f'"{v}"' for v in reversed(LINE)) + "\n")
    with pytest.raises(Exception):
        if stream:
            rows = ingest.stream_export(spark, str(folder / "bad"))
            ingest.stream_ingest(rows, str(folder / "bad-out"), str(folder / "c9")).awaitTermination()
        else:
            export.read_export(spark, str(folder / "bad")).collect()


def test_a_rerun_replaces_its_partitions_only(spark, tmp_path):
    df = spark.createDataFrame([(g, f"a{k}", f"f{k}") for g in (1, 2) for k in range(3)],
                               f"{GROUP} bigint, {ANALYTE} string, {FRAGMENT} string")
    path = str(tmp_path / "ds")
    for part in (df, df, df.filter(f"{GROUP} = 2")):
        dataset.write_indexed(part, path)
        assert dataset.read_partition(spark, path, df.schema).count() == 6


def test_colliding_ids_are_refused(spark):
    rows = spark.createDataFrame([("P", f"PEP{k}", 2, False, "y5", 1, "r.raw") for k in range(40)],
                                 "ProteinName string, PeptideModifiedSequence string, PrecursorCharge long, "
                                 "IsDecoy boolean, FragmentIon string, ProductCharge long, FileName string")
    glossary.check_ids(add_ids(rows))
    with pytest.raises(ValueError, match="analyte ids"):
        glossary.check_ids(add_ids(rows, width=1))


def test_normalise_names(spark):
    assert export.normalise_names(spark.range(1).toDF("A. b c")).columns == ["Abc"]


IDS = ["01234567", "12345678", "1e234567"]


def test_ids_survive_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(i % 2 + 1, IDS[i % 3], f"f{i}", float(i)) for i in range(12)],
                               f"{GROUP} bigint, {ANALYTE} string, {FRAGMENT} string, Area double")
    path = str(tmp_path / "ds")
    dataset.write_indexed(df, path, by=[GROUP, ANALYTE])
    back = dataset.read_partition(spark, path, df.schema)
    assert sorted(map(tuple, back.select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
    one = dataset.read_partition(spark, path, df.schema, [FRAGMENT], ID_Analyte="1e234567")
    assert {r[FRAGMENT] for r in one.collect()} == {"f2", "f5", "f8", "f11"}
    plan = one._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(ID_Analyte" in plan
    wanted = df.filter(f"{ANALYTE} <> '12345678'").select(ANALYTE)
    dataset.export_all_csv(df, str(tmp_path / "csv"), ANALYTE, glossary=wanted)
    text = dataset.read_exported_csv(spark, str(tmp_path / "csv"), df.schema)
    assert {r[ANALYTE] for r in text.collect()} == {"01234567", "1e234567"} and text.count() == 8
    dataset.export_partition_csv(df, str(tmp_path / "one"), ANALYTE, "01234567")
    assert spark.read.option("header", True).csv(str(tmp_path / "one" / "data_analyte_01234567")).count() == 4


def test_results_and_reports(spark, tmp_path):
    limits = spark.createDataFrame([(1.5, None, "01234567", "1e234567")], RESULTS["PeakBoundaries"])
    kept = spark.createDataFrame([("f1", "01234567")], RESULTS["Transitions"])
    path = str(tmp_path / "res")
    results.write_results(limits, path, "PeakBoundaries")
    results.write_results(kept, path, "Transitions")
    results.write_results(kept.withColumn(FRAGMENT, F.lit("f2")), path, "Transitions", "U")
    assert results.read_results(spark, path, "PeakBoundaries").collect() == limits.collect()
    assert {r[FRAGMENT] for r in results.read_results(spark, path, "Transitions").collect()} == {"f1", "f2"}
    # written again: replaced, for this tag only; a write without commit does not count
    results.write_results(kept, path, "Transitions")
    results.stage_results(kept.withColumn(FRAGMENT, F.lit("f9")), path, "Transitions")
    assert sorted(r[FRAGMENT] for r in results.read_results(spark, path, "Transitions").collect()) == ["f1", "f2"]
    assert results.read_results(spark, path, "ReScore").count() == 0
    for _ in range(2):
        results.write_report(kept, str(tmp_path / "rep"), "Transition_results", glossary=kept)
    read = lambda name: results.read_report(spark, str(tmp_path / "rep"), name).collect()
    assert [tuple(r) for r in read("Transition_results")] == [("f1", "01234567")] == [tuple(r) for r in read("completed_analytes")]
    # a folder of files from elsewhere has no manifest
    other = tmp_path / "other"
    other.mkdir()
    (other / "x_Report_GR_Transitions_a.csv").write_text("f7;01234567\n")
    assert [r[FRAGMENT] for r in results.read_results(spark, str(other), "Transitions").collect()] == ["f7"]


def test_stream_ingest_and_glossary(spark, folder):
    rows = ingest.stream_export(spark, str(folder / "in"), files_per_trigger=1)
    ingest.stream_ingest(rows, str(folder / "out"), str(folder / "c1")).awaitTermination()
    back = dataset.read_partition(spark, str(folder / "out"), rows.schema)
    assert back.count() == 4 and {r[REP] for r in back.select(REP).collect()} == {"b684c591"}
    again = ingest.stream_export(spark, str(folder / "in"), files_per_trigger=1)
    ingest.stream_ingest(again, str(folder / "out"), str(folder / "c1")).awaitTermination()
    assert back.count() == 4
    ingest.stream_glossary(rows, "fragment", str(folder / "g"), str(folder / "c2")).awaitTermination()
    assert sorted(r.FragmentIon for r in spark.read.parquet(str(folder / "g")).collect()) == ["y5", "y6"]
    assert LABEL in rows.columns


def test_careful_ingest_lists_what_is_bad_and_takes_the_rest(spark, folder):
    src, dst = folder / "in", str(folder / "careful")
    (src / "bad.csv").write_text("x,y\n1,2\n")
    (src / "empty.csv").write_text("")
    (src / "torn.csv").write_text(",".join(EXPORT_HEADER) + "\nP1,only,three\n")
    kind = ingest.stream_export(spark, str(src)).schema
    run = lambda: ingest.ingest_files(spark, str(src), dst, str(folder / "c5"), files_per_trigger=2).awaitTermination()
    run()
    rows = lambda: ingest.read_ingested(spark, dst, kind)
    assert rows().count() == 4 and {r[REP] for r in rows().select(REP).collect()} == {"b684c591"}
    reasons = {(r.file.rsplit("/", 1)[1], r.reason, r.line) for r in ingest.read_rejects(spark, dst).collect()}
    assert reasons == {("bad.csv", "foreign header", "x,y"),  # Spark lists no empty files
                       ("torn.csv", "line does not parse", "P1,only,three")}
    run()  # nothing new
    played = [r.batch for r in spark.read.parquet(f"{dst}/ledger").select("batch").collect()]
    ingest.ingest_batch(spark, [f"file://{src}/a.csv"], str(played[0]), dst)  # a batch played again
    assert rows().count() == 4
    # a batch that failed before its ledger row does not count, and is replaced when played again
    spark.range(3).select(F.lit("x").alias("ProteinName"), F.lit(1).alias(GROUP)).write.partitionBy(GROUP).parquet(f"{dst}/rows/batch=x-99")
    assert rows().count() == 4
    ingest.ingest_batch(spark, [f"file://{src}/b.csv"], "x-99", dst)
    assert rows().count() == 6


def test_an_id_with_two_originals_stops_the_ingest(spark, folder, monkeypatch):
    dst, src = str(folder / "clash"), folder / "in"
    monkeypatch.setattr(ingest, "add_ids", lambda df, n: add_ids(df, n).withColumn(ANALYTE, F.lit("same")))
    ingest.ingest_batch(spark, [f"file://{src}/a.csv"], "first", dst)
    text = (src / "a.csv").read_text().replace("PEPTIDE", "OTHER")
    (folder / "later").mkdir()
    (folder / "later" / "c.csv").write_text(text)
    with pytest.raises(Exception, match="several originals: analyte same"):
        ingest.ingest_files(spark, str(folder / "later"), dst, str(folder / "c6")).processAllAvailable()
    kind = ingest.stream_export(spark, str(src)).schema
    assert ingest.read_ingested(spark, dst, kind).count() == 2


def _cut(spark, n):
    rows = [(g, f"a{k // 30}", f"f{k:03d}", None if k % 7 == 0 else float(k), 'x,"y' if k % 5 else None) for g in (1, 2) for k in range(n)]
    return spark.createDataFrame(rows, f"{GROUP} bigint, {ANALYTE} string, {FRAGMENT} string, Area double, note string")


def test_a_directory_per_analyte_is_written_by_the_tasks(spark, tmp_path, monkeypatch):
    """Keys cut over partitions, odd names, replaced and kept directories; no directory goes through Spark's writer."""
    df = _cut(spark, 90)
    odd = df.filter(f"{FRAGMENT} < 'f003'").withColumn(ANALYTE, F.when(F.col(FRAGMENT) == "f001", F.lit("a=/b%")))
    path, every = str(tmp_path / "ds"), df.unionByName(odd)
    monkeypatch.setattr(dataset, "many_tasks", lambda _: 40)
    for part in (every, every, every.filter(f"{ANALYTE} = 'a1'")):
        dataset.write_indexed(part, path, [GROUP, ANALYTE])
    back = dataset.read_partition(spark, path, df.schema)
    key = lambda rows: sorted(map(tuple, rows), key=str)
    assert key(back.select(*df.columns).collect()) == key(every.collect())
    names = sorted(p.name for p in (tmp_path / "ds").iterdir())
    assert names == [f"{GROUP}=1", f"{GROUP}=2"]
    inside = sorted(p.name for p in (tmp_path / "ds" / f"{GROUP}=1").iterdir())
    assert inside == sorted([f"{ANALYTE}={x}" for x in ("a0", "a1", "a2", "a%3D%2Fb%25", "__HIVE_DEFAULT_PARTITION__")])
    assert not list((tmp_path / "ds").rglob("*.crc"))  # Spark's writer adds one to every file
    assert len(list((tmp_path / "ds" / f"{GROUP}=1" / f"{ANALYTE}=a1").iterdir())) > 1


def test_csv_of_every_analyte_is_that_of_sparks_writer(spark, tmp_path):
    df = _cut(spark, 90).drop(GROUP)
    dataset.export_all_csv(df, str(tmp_path / "csv"), ANALYTE)
    df.repartition(1).sortWithinPartitions(ANALYTE, FRAGMENT).write.partitionBy(ANALYTE).option("header", True).options(
        **export.QUOTED).csv(str(tmp_path / "plain"))
    lines = lambda top: {p.name: sorted(x for f in p.glob("part-*") for x in f.read_text().splitlines()[1:])
                         for p in (tmp_path / top).glob(f"{ANALYTE}=*")}
    heads = {f.read_text().splitlines()[0] for top in ("csv", "plain") for f in (tmp_path / top).rglob("part-*.csv")}
    assert lines("csv") == lines("plain") and heads == {f"{FRAGMENT},Area,note"}
    assert not list((tmp_path / "csv").rglob("*.crc"))
    back = dataset.read_exported_csv(spark, str(tmp_path / "csv"), df.schema).select(*df.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    with pytest.raises(Exception):
        dataset.export_all_csv(df, str(tmp_path / "csv"), ANALYTE)


def _colliding():
    """Two peptides whose analyte ids are the same eight digits."""
    import hashlib
    seen = {}
    for k in range(400_000):
        name = f"PEP{k}"
        short = hashlib.sha256(f"P1_{name}_2False".encode()).hexdigest()[:8]
        if short in seen:
            return seen[short], name, short
        seen[short] = name
    raise AssertionError


def test_two_originals_of_one_hash_get_two_ids(spark, folder):
    one, two, short = _colliding()
    rows = add_ids(spark.createDataFrame([("P1", p, 2, False, "y5", 1, "r.raw") for p in (one, two, "PEP", one)],
                                         "ProteinName string, PeptideModifiedSequence string, PrecursorCharge long, "
                                         "IsDecoy boolean, FragmentIon string, ProductCharge long, FileName string"))
    with pytest.raises(ValueError, match=short):
        glossary.check_ids(rows)
    split = glossary.split_ids(rows)
    glossary.check_ids(split)
    ids = {r.PeptideModifiedSequence: r[ANALYTE] for r in split.collect()}
    first, second = sorted([one, two])
    assert ids[first] == short and ids[second].startswith(short) and len(ids[second]) == 16 and len(ids["PEP"]) == 8
    assert split.count() == 4 and split.columns == rows.columns
    # the ingest: the one that came first keeps the id, also when both come again
    text, dst = (folder / "in" / "a.csv").read_text(), str(folder / "two")
    for batch, names in enumerate(([second], [first, second], [second, first])):
        (folder / f"b{batch}").mkdir()
        for name in names:
            (folder / f"b{batch}" / f"{name}.csv").write_text(text.replace("PEPTIDE,PEPTIDE", f"{name},{name}"))
        ingest.ingest_batch(spark, [f"file://{f}" for f in sorted((folder / f"b{batch}").iterdir())], str(batch), dst)
    kind = ingest.stream_export(spark, str(folder / "in")).schema
    got = {(r.PeptideModifiedSequence, r[ANALYTE][:8], len(r[ANALYTE])) for r in ingest.read_ingested(spark, dst, kind).collect()}
    assert got == {(second, short, 8), (first, short, 16)}
    assert ingest.read_ingested(spark, dst, kind).count() == 10
