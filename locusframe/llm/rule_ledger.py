"""Quality rules kept in a bitmask ledger.

Every rule is evaluated once per document; the ledger stores the measurements and one bit per rule that
failed. A policy is a versioned set of rules, so a verdict is a bitwise AND with its mask, and what a policy
would keep without one of its rules follows from counts per mask: neither reads a text again.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ASCII white space, the counted symbols, and the marks that end a line of prose.
SPACE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
ENDS = (b".", b"!", b"?", b'"', b":", b";", b",", b")")
_letterless = bytes(range(128)).translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, n_dup_lines bigint, n_ended_lines bigint, n_repeat_words bigint, n_letter_words bigint"


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of a whole text, in the order of ``MEASURES``; a null text counts as empty.

    Words are what stands between ASCII white space. ``n_repeat_words`` counts words inside three-word windows
    that occur twice or more; a letter word holds an ASCII letter or any sign beyond ASCII.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    chars = len(text or "") - (len(raw) - len(raw.translate(None, SPACE)))
    letters = sum(map(bool, (w.translate(None, _letterless) for w in words)))
    return (n, chars, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines), len(lines) - len(set(lines)),
            sum(line.rstrip().endswith(ENDS) for line in lines), repeated_words(words), letters)


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words covered by windows of ``size`` words that occur at least twice; windows are compared word by word."""
    windows = list(zip(*(words[k:] for k in range(size))))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, until = 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + size - max(at, until)
            until = at + size
    return covered


@dataclass(frozen=True)
class Rule:
    """A document fails the rule where ``fails``, SQL over the measurements, holds; ``bit`` is its place for good."""

    bit: int
    name: str
    fails: str


#: The ledger's rules. A bit is never given to another rule; a changed threshold is a new rule.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "short_words", "word_chars < 3 * n_words"),
    Rule(3, "long_words", "word_chars > 10 * n_words"),
    Rule(4, "symbols", "100 * n_symbols > 10 * n_words"),
    Rule(5, "repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule(6, "letterless_words", "100 * n_letter_words < 80 * n_words"),
    Rule(7, "open_lines", "n_lines > 1 AND 100 * n_ended_lines < 10 * n_lines"),
    Rule(8, "any_repeated_line", "n_dup_lines > 0"),
    Rule(9, "many_words", "n_words > 100000"),
)


@dataclass(frozen=True)
class Policy:
    """A versioned choice of rules; a document is kept when at most ``allowed`` of them fail."""

    version: str
    rules: tuple[str, ...]
    allowed: int = 0

    def mask(self, rules: tuple[Rule, ...] = RULES) -> int:
        bits = {r.name: r.bit for r in rules}
        missing = [name for name in self.rules if name not in bits]
        if missing:
            raise ValueError(f"policy {self.version} names rules that the ledger does not hold: {missing}")
        return sum({1 << bits[name] for name in self.rules})


BASE = Policy("base", ("few_words", "repeated_windows"))
STANDARD = Policy("standard-1", ("few_words", "repeated_windows", "short_words", "long_words", "symbols", "repeated_lines", "letterless_words", "open_lines"))


def quality_ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``doc_id``, the measurements, ``failed``) per row of ``docs``, where bit b of ``failed`` is set if rule b fails.

    Whole texts are measured, however long. Null and empty texts have no words and fail ``few_words`` only; null ids and
    repeated rows are kept as they are, and equal texts get equal entries. Other columns of the input, whatever
    their names, are neither read nor returned. An empty table gives an empty ledger.
    """
    if len({r.bit for r in rules}) < len(rules) or any(not 0 <= r.bit < 63 for r in rules):
        raise ValueError("every rule needs a bit of its own from 0 to 62")

    @F.pandas_udf(MEASURES)
    def measured(texts: pd.Series) -> pd.DataFrame:
        names = [field.split()[0] for field in MEASURES.split(", ")]
        return pd.DataFrame([measure(t) for t in texts], columns=names, dtype="int64")

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).select("doc_id", measured("text").alias("m")).select("doc_id", "m.*")
    failed = F.lit(0).cast("bigint")
    for r in rules:
        failed = failed.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return rows.withColumn("failed", failed)


def kept_by(policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether a policy keeps a row of the ledger."""
    return F.bit_count(F.col("failed").bitwiseAND(F.lit(policy.mask(rules)).cast("bigint"))) <= policy.allowed


def ablations(ledger: DataFrame, policies: list[Policy], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """What every rule of every policy does: (version, rule, n_docs, n_kept, n_failed, n_sole, n_kept_without).

    ``n_failed`` documents fail the rule, ``n_sole`` of them fail no other rule of the policy, and ``n_kept_without`` would be
    kept if the policy lost the rule. Rows of the ledger are counted per mask first, of which there are at most 2 to
    the number of rules, so the texts are not read again. An empty ledger gives counts of 0.
    """
    bits = {r.name: r.bit for r in rules}
    entries = [
        F.struct(F.lit(p.version).alias("version"), F.lit(name).alias("rule"), F.lit(p.mask(rules)).cast("bigint").alias("mask"), F.lit(p.allowed).alias("allowed"),
                 F.lit(1 << bits[name]).cast("bigint").alias("bit"))
        for p in policies for name in p.rules]
    if not entries:
        raise ValueError("ablations need a policy with a rule")
    asked = ledger.sparkSession.createDataFrame([(p.version, name) for p in policies for name in p.rules], "version string, rule string")
    masks = ledger.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    met = masks.select("failed", "n", F.explode(F.array(*entries)).alias("e")).select("failed", "n", "e.*")
    own = F.col("failed").bitwiseAND(F.col("mask"))
    others = own.bitwiseAND(F.bitwise_not("bit"))

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    counted = met.groupBy("version", "rule").agg(
        F.sum("n").alias("n_docs"), total(F.bit_count(own) <= F.col("allowed")).alias("n_kept"), total(own.bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(own == F.col("bit")).alias("n_sole"), total(F.bit_count(others) <= F.col("allowed")).alias("n_kept_without"))
    return asked.join(counted, ["version", "rule"], "left").na.fill(0)


def profile(ledger: DataFrame, *keys: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per key the rules that some (``any_failed``) and that all (``all_failed``) documents fail, by bitwise OR and AND."""
    names = F.array(*[F.struct(F.lit(1 << r.bit).cast("bigint").alias("bit"), F.lit(r.name).alias("name")) for r in rules])

    def named(mask: str) -> Column:
        return F.transform(F.filter(names, lambda r: r["bit"].bitwiseAND(F.col(mask)) != 0), lambda r: r["name"])

    sums = ledger.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_docs"), F.bit_or("failed").alias("_any"), F.bit_and("failed").alias("_all"))
    return sums.select(*keys, "n_docs", named("_any").alias("any_failed"), named("_all").alias("all_failed"))
