"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document: its measurement is kept, and a bit says whether the document fails it. A
policy is a versioned set of rules, that is a mask; what it keeps, and what each rule adds to it, follow from the stored
bits by bitwise operations, without reading a text again. Only DataFrame and SQL functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buildlens.llm.common import WORD

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """A document fails if the SQL condition over the measurements holds. ``bit`` is the rule's place for good."""

    bit: int
    name: str
    fails: str


#: Rules are only ever added: a stored ledger stays valid.
RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "many_symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 14 * n_words"),
    Rule(6, "capitals", "2 * n_capitals > word_chars"),
)
#: Masks of the policies by version.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "many_symbols", "repeated_lines"),
    "v2": tuple(rule.name for rule in RULES),
}
CURRENT = "v2"


def mask(policy: str, rules: tuple[Rule, ...] = RULES) -> int:
    bits = {rule.name: 1 << rule.bit for rule in rules}
    return sum(bits[name] for name in POLICIES[policy])


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def measured(documents: DataFrame, text: str = "text") -> DataFrame:
    """row, and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_capitals, n_repeat_words of every row.

    ``row`` holds the row's columns, whatever their names. A null text is empty, an empty text measures 0 everywhere.
    Lines without a word do not count as lines. n_repeat_words counts the words in windows of five words that are found
    twice or more in the text, the first time included. Windows are compared by a 64-bit hash. Where all are different,
    nothing else is done; else the windows are sorted by hash, those equal to a neighbour are put in order of place, and
    each covers five words or those up to the next one.
    """
    whole = F.coalesce(F.col("row")[text], F.lit(""))
    read = documents.select(F.struct(*documents.columns).alias("row")).select(
        "row",
        F.filter(F.split(whole, r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"),
        F.filter(F.split(whole, "\n"), lambda x: F.regexp_like(x, F.lit(WORD))).alias("lines"),
        _count(whole, SYMBOLS).alias("n_symbols"),
        _count(whole, r"\p{Lu}").alias("n_capitals"),
    )
    last = F.size("words") - WINDOW
    window = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice("words", i + 1, F.lit(WINDOW))))
    hashed = read.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_capitals",
        F.when(last >= 0, window).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    hashed = hashed.withColumn("placed", F.when(repeats, placed)).drop("windows")

    def found_again(x: Column, i: Column) -> Column:
        return (x["h"] == F.get("placed", i - 1)["h"]).eqNullSafe(True) | (
            x["h"] == F.get("placed", i + 1)["h"]
        ).eqNullSafe(True)

    places = F.sort_array(F.transform(F.filter("placed", found_again), lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )
    return hashed.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("placed")


def ledger(documents: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measurements of every row and ``failed_bits``, a long with the bit of each rule that the row fails."""
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return measured(documents, text).withColumn("failed_bits", bits)


def fails(policy: str) -> Column:
    """Whether a row of a ledger fails a rule of the policy."""
    return F.col("failed_bits").bitwiseAND(F.lit(mask(policy))) != 0


def ablation(stored: DataFrame, policy: str = CURRENT, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """rule, failed, failed_alone, kept_without for each rule of the policy: how many rows fail it, fail nothing else,
    and would be kept without it. The ledger is counted by its masked bits once; an empty one gives zeros."""
    bits = F.col("failed_bits").bitwiseAND(F.lit(mask(policy)))
    counted = stored.groupBy(bits.alias("bits")).agg(F.count("*").alias("n"))
    own = [rule for rule in rules if rule.name in POLICIES[policy]]

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")

    held = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            total(F.col("bits").bitwiseAND(F.lit(1 << rule.bit)) != 0).alias("failed"),
            total(F.col("bits") == 1 << rule.bit).alias("failed_alone"),
            total(F.col("bits").bitwiseAND(F.lit(mask(policy) & ~(1 << rule.bit))) == 0).alias("kept_without"),
        )
        for rule in own
    ]
    return counted.agg(F.array(*held).alias("held")).select(F.inline("held"))


def verdicts(documents: DataFrame, policy: str = CURRENT) -> DataFrame:
    """doc_id, the measurements, base_failed, kept and failed_bits of every row of ``documents``."""
    return ledger(documents.select("doc_id", "text")).select(
        "row.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        fails("base").alias("base_failed"),
        (~fails("base") & ~fails(policy)).alias("kept"),
        "failed_bits",
    )
