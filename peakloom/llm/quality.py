"""Rule bitmask ledger: every rule is evaluated once, its failures are bits, policies are masks.

`ledger` adds measurements and the failure bits, `apply_policy` turns bits into a verdict under a named
policy, `ablations` counts from the bits alone what each rule of a policy adds. Built-in functions only,
no shuffle; a policy can change without reading the texts again.

Defined cases: a null text counts as an empty one (no words, fails `few_words`); an empty table gives an
empty ledger; repeated rows are judged one by one; other columns are kept whatever their names, but one named
like a measurement, `failed`, or a verdict of `apply_policy` is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakloom.llm.common import BLANKS, masked, set_aside

WINDOW = 5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_exclaim", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """Fails where `test` is true. Its bit is its place in RULES and must never be reused."""
    name: str
    test: str


RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("word_length", "word_chars > 15 * n_words OR word_chars < 2 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule("shouting", "10 * n_exclaim > 5 * n_words"),
)
BIT = {rule.name: 1 << place for place, rule in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_words"]
#: A policy is a version and the rules that reject under it.
POLICIES = {
    "base-1": BASE,
    "web-1": BASE | BIT["symbols"] | BIT["word_length"],
    "web-2": BASE | BIT["symbols"] | BIT["word_length"] | BIT["repeated_lines"] | BIT["shouting"],
}


def _repeat_columns(df: DataFrame) -> DataFrame:
    """`n_repeat_words` from `_words`: words in windows of five that occur twice or more in the text.

    Each step reads the one before as a column, so no array is built twice. Only texts with a repeated
    window sort (window, place) pairs.
    """
    count = F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0))
    df = df.withColumn("_codes", F.transform("_words", lambda w: F.xxhash64(w)))
    df = df.withColumn("_grams", F.transform(
        F.arrays_zip(*[F.slice("_codes", k + 1, count).alias(f"c{k}") for k in range(WINDOW)]),
        lambda z: F.xxhash64(z)))
    df = df.withColumn("_pairs", F.when(
        F.size(F.array_distinct("_grams")) < F.size("_grams"),
        F.sort_array(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    rest = lambda name: F.slice(name, 2, F.greatest(F.size(name), F.lit(1)))
    df = df.withColumn("_starts", F.sort_array(F.array_distinct(F.flatten(F.zip_with(
        "_pairs", rest("_pairs"),
        lambda a, b: F.when(a["g"] == b["g"], F.array(a["i"], b["i"]))
        .otherwise(F.array().cast("array<int>")))))))
    covered = F.zip_with("_starts", rest("_starts"), lambda a, b: F.least(F.lit(WINDOW), b - a))
    return df.withColumn("n_repeat_words", F.coalesce(
        F.aggregate(covered, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(WINDOW))), F.lit(0)).cast("bigint"))


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of `docs`, the measurements, and `failed`: one bit per rule."""
    aside, kept = set_aside(docs, [text], [*MEASURES, "failed"])
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = aside.withColumn("_text", whole).withColumn("_words", F.array_remove(F.split("_text", BLANKS), ""))
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    symbols: Column = F.regexp_count("_text", F.lit(r"[#*$%&|<>]"))
    df = df.withColumns({
        "n_words": F.size("_words").cast("bigint"),
        "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
        "n_symbols": symbols.cast("bigint"),
        "n_lines": F.size("_lines").cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "n_exclaim": (F.length("_text") - F.length(F.replace("_text", F.lit("!"), F.lit("")))).cast("bigint"),
    })
    df = _repeat_columns(df).select(*kept, *MEASURES)
    bits = [F.when(F.expr(rule.test), F.lit(BIT[rule.name])).otherwise(0) for rule in RULES]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return df.withColumn("failed", failed.cast("bigint"))


def apply_policy(led: DataFrame, policy: str) -> DataFrame:
    """Adds `base_failed` and `kept` under a policy."""
    hit = lambda mask: F.col("failed").bitwiseAND(F.lit(mask).cast("bigint")) != 0
    return led.withColumns({"base_failed": hit(BASE), "kept": ~hit(BASE | POLICIES[policy])})


def keep(docs: DataFrame, policy: str) -> DataFrame:
    """The rows of `docs` that pass, with their own columns only."""
    aside, back = masked(docs, "text")
    # the row number keeps the filter above the measurements; pushed below, it would compute them again
    led = apply_policy(ledger(aside), policy).withColumn("_row", F.monotonically_increasing_id())
    return back(led.where(F.col("kept") & (F.col("_row") >= 0)))


def ablations(led: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: `n_failed` rows that fail it, `n_only` rows that fail no other rule of the
    policy (they would be kept without it). Rows are first counted per bit pattern, at most 2^rules."""
    mask = F.lit(POLICIES[policy]).cast("bigint")
    patterns = led.groupBy(F.col("failed").bitwiseAND(mask).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(BIT[r.name]).cast("bigint").alias("bit"))
                      for r in RULES if BIT[r.name] & POLICIES[policy]])
    each = patterns.select("bits", "n", F.explode(rules).alias("r")).select("bits", "n", "r.rule", "r.bit")
    fails = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(fails, F.col("n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n"))), F.lit(0)).alias("n_only"))
