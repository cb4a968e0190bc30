import hashlib

from pyspark.sql import functions as F

from peakloom.functions import keys as ks
from peakloom.operators import glossary as gl
from peakloom.schema import ANALYTE, FRAGMENT, GROUP, REP


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_hash8_golden(spark):
    golden = {"P1_PEPTIDE_2False": "43801017", "P1_PEPTIDEK_2False": "8a3342f1", "P2_SAMPLER_3True": "33e3cc6f",
              "y5_1": "b08ef028", "y6_1": "792f60ab", "b3_1": "e0627098", "y2_1": "063ff5aa",
              "run1.raw": "b684c591", "run2.raw": "569698fa"}
    df = spark.createDataFrame([(k,) for k in golden], "k string").select("k", ks.hash8(F.col("k")).alias("h"))
    assert {r.k: r.h for r in df.collect()} == golden
    assert one(spark, ks.hash8(F.lit("abc"), "salt")) == "36810999"


def test_bytes_salt(spark):
    assert one(spark, ks.sha256_salted(F.lit("abc"), b"\xff\x00")) == hashlib.sha256(b"\xff\x00abc").hexdigest()


def test_prefix_bucket_golden(spark):
    golden = {"aa": 1, "c9": 2, "cc": 1, "cd": 1, "df": 2, "f5": 3, "00": 3, "42": 4, "99": 6,
              "8a3342f1": 6, "33e3cc6f": 4, "b08ef028": 1, "792f60ab": 6, "e0627098": 2, "063ff5aa": 3,
              "b684c591": 1, "569698fa": 5}
    df = spark.createDataFrame([(k,) for k in golden], "k string").select(
        "k", ks.prefix_bucket(F.col("k"), 6).alias("g"))
    assert {r.k: r.g for r in df.collect()} == golden
    sizes = [ks.bucket_table(6).count(g) for g in range(1, 7)]
    assert sizes == [43, 43, 42, 43, 42, 43]
    assert all(max(ks.bucket_table(n)) == n for n in (1, 2, 7, 100, 105, 117, 256))
    assert one(spark, ks.prefix_bucket(F.lit("zz"), 6)) is None


def test_add_ids_text_rules(spark):
    rows = [("P1", "PEPTIDE", 2, False, "y5", 1, "run1.raw"), ("P2", "SAMPLER", 3, True, "y6", 1, "run2.raw"),
            (None, "PEPTIDE", None, None, "b3", 1, "run1.raw")]
    df = spark.createDataFrame(rows, "ProteinName string, PeptideModifiedSequence string, PrecursorCharge bigint, "
                                     "IsDecoy boolean, FragmentIon string, ProductCharge bigint, FileName string")
    out = ks.add_ids(df, 6).select(ANALYTE, FRAGMENT, REP, GROUP).collect()
    missing = hashlib.sha256(b"nan_PEPTIDE_nannan").hexdigest()[:8]
    assert [tuple(r)[:3] for r in out] == [("43801017", "b08ef028", "b684c591"), ("33e3cc6f", "792f60ab", "569698fa"),
                                           (missing, "e0627098", "b684c591")]


def test_run_label(spark):
    label = ks.run_label(F.lit("r1"), F.lit("a b"), F.lit("light"))
    assert one(spark, label) == "Rep_r1 Analyte_a b IsotopeLabelType_light"
    parts = ks.parse_run_label(label)
    assert [one(spark, parts[name]) for name in (REP, ANALYTE, "IsotopeLabelType")] == ["r1", "a b", "light"]


def test_merge_and_collisions(spark):
    old = spark.createDataFrame([("1", "x"), ("2", "y")], "id string, name string")
    new = spark.createDataFrame([("2", "y"), ("2", "z")], "id string, name string")
    merged = gl.merge_glossary(old, new)
    assert merged.count() == 3
    assert [tuple(r) for r in gl.id_collisions(merged, "id").collect()] == [("2", 2)]
