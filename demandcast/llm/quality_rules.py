"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once per document. The ledger keeps the measurements
and one ``failures`` bitmask (bit i = rule i failed). A policy is a named,
versioned set of rules: a document passes it if ``failures & policy mask`` is
zero, so new policies and ablations (what each rule rejects, alone or first)
are computed from the ledger without reading a text again; ablations go
through the histogram of masks, at most 2^rules rows.

Cases: a null or empty text has no words and fails ``too_few_words``; repeated
rows are judged one by one; an empty table gives an empty ledger; ratios over
zero words are never taken (all comparisons are cross-multiplied integers).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import WORD_SPACE, pick

# Fixed values of the result contract.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails`` (over the measurements) is true."""

    name: str
    fails: Column


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]


def default_rules() -> list[Rule]:
    c = F.col
    return [
        Rule("too_few_words", c("n_words") < MIN_WORDS),
        Rule("repeated_windows", c("n_repeat_words") * 100 > c("n_words") * MAX_REPEAT_PERCENT),
        # a symbol for more than every third word
        Rule("symbols", c("n_symbols") * 3 > c("n_words")),
        Rule("repeated_lines", (c("n_lines") > 3) & (c("n_dup_lines") * 2 > c("n_lines"))),
        Rule("odd_word_length", (c("word_chars") < c("n_words") * 2) | (c("word_chars") > c("n_words") * 25)),
        Rule("shouting", c("n_upper") * 2 > c("word_chars")),
    ]


BASE = Policy("base", 1, ("too_few_words", "repeated_windows"))
POLICIES = (
    BASE,
    Policy("structure", 1, ("too_few_words", "repeated_windows", "repeated_lines", "odd_word_length")),
    Policy("strict", 2, ("too_few_words", "repeated_windows", "symbols", "repeated_lines", "odd_word_length", "shouting")),
)
PRODUCTION = POLICIES[-1]


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return F.array_remove(F.split(F.translate(text, WORD_SPACE, " " * len(WORD_SPACE)), " "), "")


def _repeat_words(hashes: Column) -> Column:
    """Words covered by WINDOW-word windows that occur twice or more.

    ``hashes`` holds one 64-bit hash per word. Only a text with a repeated
    window sorts its windows; covered words are then the sum, over repeated
    windows by position, of the distance to the next one, WINDOW at most.
    """
    size = F.size(hashes)
    starts = F.sequence(F.lit(1), size - F.lit(WINDOW - 1))
    windows = F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))

    def covered(w: Column) -> Column:
        placed = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            here = lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])
            at = F.array_sort(F.transform(F.filter(s, lambda x, k: F.coalesce(here(x, k), F.lit(False))), lambda x: x["i"]))
            gaps = lambda p: F.transform(p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
            return let(at, lambda p: F.aggregate(gaps(p), F.lit(0), lambda a, b: a + b))

        return let(placed, repeated)

    count = let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))
    return F.when(size < WINDOW, F.lit(0)).otherwise(count).cast("long")


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements per document: n_words, word_chars, n_symbols, n_lines
    (lines with a word), n_dup_lines, n_upper (A-Z), n_repeat_words."""
    base = pick(df, id_col, text_col).toDF(id_col, "_text").withColumn("_text", F.coalesce(F.col("_text").cast("string"), F.lit("")))
    text = F.col("_text")
    squeezed = F.translate(text, WORD_SPACE + " ", "")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, WORD_SPACE + " ", "")) > 0)
    return (
        base.withColumn("_hash", F.transform(words_of(text), lambda w: F.xxhash64(w)))
        .withColumn("_lines", lines)
        .select(
            id_col,
            F.size("_hash").cast("long").alias("n_words"),
            F.length(squeezed).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            F.size("_lines").cast("long").alias("n_lines"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            (F.length(text) - F.length(F.translate(text, upper, ""))).cast("long").alias("n_upper"),
            _repeat_words(F.col("_hash")).alias("n_repeat_words"),
        )
    )


def ledger(measured: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """The measurements with ``failures``, one bit per rule (bit i = rule i)."""
    rules = rules or default_rules()
    mask = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        mask = mask.bitwiseOR(F.when(rule.fails, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("failures", mask)


def policy_mask(policy: Policy, rules: list[Rule] | None = None) -> int:
    names = [r.name for r in rules or default_rules()]
    return sum(1 << names.index(r) for r in policy.rules)


def passes(policy: Policy, rules: list[Rule] | None = None) -> Column:
    return F.col("failures").bitwiseAND(F.lit(policy_mask(policy, rules)).cast("long")) == 0


def apply_policy(book: DataFrame, policy: Policy = PRODUCTION, rules: list[Rule] | None = None) -> DataFrame:
    return book.withColumn("kept", passes(policy, rules))


def ablations(book: DataFrame, policies: tuple[Policy, ...] = POLICIES, rules: list[Rule] | None = None) -> DataFrame:
    """Per policy and rule of it: documents the policy rejects, documents the
    rule fails, and documents kept again if that rule alone were dropped."""
    rules = rules or default_rules()
    names = [r.name for r in rules]
    masks = book.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))  # at most 2^rules rows
    cases = [
        F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(r).alias("rule"),
                 F.lit(policy_mask(p, rules)).cast("long").alias("mask"), F.lit(1 << names.index(r)).cast("long").alias("bit"))
        for p in policies for r in p.rules
    ]
    hit = F.col("failures").bitwiseAND(F.col("c.mask"))
    one = lambda when: F.sum(F.when(when, F.col("n")).otherwise(F.lit(0))).cast("long")
    return (
        masks.withColumn("c", F.explode(F.array(*cases)))
        .groupBy(F.col("c.policy").alias("policy"), F.col("c.version").alias("version"), F.col("c.rule").alias("rule"))
        .agg(one(hit != 0).alias("rejected"),
             one(F.col("failures").bitwiseAND(F.col("c.bit")) != 0).alias("failed"),
             one(hit == F.col("c.bit")).alias("only_this_rule"))
    )
