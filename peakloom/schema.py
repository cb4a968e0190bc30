"""Column names and explicit schemas. Nothing is ever inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

ANALYTE = "ID_Analyte"
REP = "ID_Rep"
LABEL = "IsotopeLabelType"
FRAGMENT = "ID_FragmentIon_charge"
GROUP = "ID_group"
RUN = [ANALYTE, REP, LABEL]
CELL = [*RUN, FRAGMENT]

_S, _B, _L, _D = T.StringType(), T.BooleanType(), T.LongType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# The 22 columns of an export and their types.
EXPORT = _struct(
    ("ProteinName", _S),
    ("PeptideModifiedSequence", _S),
    ("ModifiedSequence", _S),
    ("IsotopeLabelType", _S),
    ("IsDecoy", _B),
    ("PrecursorCharge", _L),
    ("PrecursorMz", _D),
    ("ProductCharge", _L),
    ("ProductMz", _D),
    ("FragmentIon", _S),
    ("TransitionLocator", _S),
    ("Quantitative", _B),
    ("FileName", _S),
    ("LibraryDotProduct", _D),
    ("MinStartTime", _D),
    ("MaxEndTime", _D),
    ("Area", _D),
    ("LibraryIntensity", _D),
    ("InterpolatedTimes", _S),
    ("InterpolatedIntensities", _S),
    ("InterpolatedMassErrors", _S),
    ("PrecursorResultLocator", _S),
)

# Header text of the same 22 columns in the export file.
EXPORT_HEADER = [
    "Protein Name",
    "Peptide Modified Sequence",
    "Modified Sequence",
    "Isotope Label Type",
    "Is Decoy",
    "Precursor Charge",
    "Precursor Mz",
    "Product Charge",
    "Product Mz",
    "Fragment Ion",
    "Transition Locator",
    "Quantitative",
    "File Name",
    "Library Dot Product",
    "Min Start Time",
    "Max End Time",
    "Area",
    "Library Intensity",
    "Interpolated Times",
    "Interpolated Intensities",
    "Interpolated Mass Errors",
    "Precursor Result Locator",
]

INDEXED = T.StructType(
    [*EXPORT.fields, *_struct((FRAGMENT, _S), (REP, _S), (ANALYTE, _S), (GROUP, _L)).fields]
)

# Stands for a missing label.
NO_LABEL = "NA"

# Text read as missing.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# Glossary columns by kind.
GLOSSARIES = {
    "fragment": [FRAGMENT, "FragmentIon", "ProductCharge"],
    "rep": [REP, "FileName"],
    "locator": ["TransitionLocator", FRAGMENT, ANALYTE],
    "analyte": [ANALYTE, "ProteinName", "PeptideModifiedSequence", "PrecursorCharge", "IsDecoy"],
    "analyte_group": [ANALYTE, "ProteinName", "PeptideModifiedSequence", "PrecursorCharge",
                      "IsDecoy", GROUP],
    "precursor": ["PrecursorResultLocator", "ProteinName", "PeptideModifiedSequence",
                  "IsotopeLabelType", "PrecursorCharge", "IsDecoy", "FileName"],
}

SCORE_COLUMNS = [ANALYTE, LABEL, REP, "SimilarityScore", "MPRAScore", "Librarydotp",
                 "IntensityScore", "ScoreMassError", "Comment"]

_SCORE = _struct((ANALYTE, _S), (LABEL, _S), (REP, _S), ("SimilarityScore", _D), ("MPRAScore", _D),
                 ("Librarydotp", _D), ("IntensityScore", _D), ("ScoreMassError", _D),
                 ("Comment", _S))

# Result kinds: the part of the file name that tells them apart, and their columns.
RESULTS = {
    "PeakBoundaries": _struct(("MinStartTime", _D), ("MaxEndTime", _D), (REP, _S), (ANALYTE, _S)),
    "Transitions": _struct((FRAGMENT, _S), (ANALYTE, _S)),
    "Replicate": _SCORE,
    "ReScore": _SCORE,
}
