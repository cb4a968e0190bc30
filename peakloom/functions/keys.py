"""Hashed keys, prefix buckets and run labels."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakloom.schema import ANALYTE, FRAGMENT, GROUP, LABEL, NO_LABEL, REP

# Fixed value: order of the hex digits used for bucketing.
HEX_ORDER = "abcdef0123456789"
# Digits of an id that would else be that of two originals.
LONG_ID = 16


def sha256_salted(col: Column, salt: str | bytes = "") -> Column:
    """Hex SHA-256 of the value with the salt put in front; a bytes salt is used as it is."""
    if isinstance(salt, bytes):
        return F.sha2(F.concat(F.lit(salt), F.encode(col.cast("string"), "UTF-8")), 256)
    return F.sha2(F.concat(F.lit(salt), col.cast("string")), 256)


def hash8(col: Column, salt: str | bytes = "", width: int = 8) -> Column:
    """The first `width` hex characters of the salted digest."""
    return F.substring(sha256_salted(col, salt), 1, width)


def key_text(df: DataFrame, name: str) -> Column:
    """The text a column contributes to a key: missing is `nan`, booleans are capitalised."""
    col = F.col(name)
    if df.schema[name].dataType.typeName() == "boolean":
        text = F.initcap(col.cast("string"))
    else:
        text = col.cast("string")
    return F.coalesce(text, F.lit("nan"))


def id_texts(df: DataFrame) -> dict[str, Column]:
    """The text that each id is the hash of."""
    part = lambda name: key_text(df, name)
    return {
        FRAGMENT: F.concat(part("FragmentIon"), F.lit("_"), part("ProductCharge")),
        REP: part("FileName"),
        ANALYTE: F.concat(part("ProteinName"), F.lit("_"), part("PeptideModifiedSequence"), F.lit("_"),
                          part("PrecursorCharge"), part("IsDecoy")),
    }


def add_ids(df: DataFrame, n_groups: int | None = None, width: int = 8) -> DataFrame:
    """Add the analyte, fragment and replicate keys, and the group if `n_groups` is given."""
    texts = id_texts(df)
    if LABEL in df.columns:
        # a missing label is a label of its own, so its rows match in every join
        df = df.withColumn(LABEL, F.coalesce(LABEL, F.lit(NO_LABEL)))
    out = df.withColumns({name: hash8(text, width=width) for name, text in texts.items()})
    if n_groups is not None:
        out = out.withColumn(GROUP, prefix_bucket(F.col(ANALYTE), n_groups))
    return out


def long_id(name: str, text: Column) -> Column:
    """The id in column `name` for a text that has to make way for another with the same hash: twice as many digits,
    which begin with those of the short one. An id that is no such hash stays."""
    longer = hash8(text, width=LONG_ID)
    return F.when(longer.startswith(F.col(name)), longer).otherwise(F.col(name))


def bucket_table(n: int) -> list[int]:
    """Group of each of the 256 two-digit prefixes: `n` right-closed equal-width bins over 0..255,
    numbered in order of appearance."""
    edges = np.linspace(0, 255, n + 1)
    bins = np.searchsorted(edges[1:], np.arange(256), side="left")
    return [int(rank) + 1 for rank in np.unique(bins, return_inverse=True)[1]]


def prefix_bucket(col: Column, n: int) -> Column:
    """Bucket 1..n of a hex key from its first two characters."""
    digit = lambda at: F.instr(F.lit(HEX_ORDER), F.substring(col, at, 1)) - 1
    table = F.array(*[F.lit(group).cast("bigint") for group in bucket_table(n)])
    high, low = digit(1), digit(2)
    return F.when((high >= 0) & (low >= 0), F.get(table, high * 16 + low))


def run_label(rep: Column, analyte: Column, label: Column) -> Column:
    """`Rep_<r> Analyte_<a> IsotopeLabelType_<l>`; null if a part is null."""
    return F.concat(F.lit("Rep_"), rep, F.lit(" Analyte_"), analyte, F.lit(" IsotopeLabelType_"),
                    label)


def parse_run_label(col: Column) -> dict[str, Column]:
    """The three parts of a run label, also when blanks were turned into dots."""
    pattern = r"^Rep_(.*?)[ .]Analyte_(.*?)[ .]IsotopeLabelType_(.*)$"
    return {name: F.regexp_extract(col, pattern, group)
            for group, name in ((1, REP), (2, ANALYTE), (3, LABEL))}
