"""Quality rules as a ledger: measure once, store failure bits, decide by versioned policies.

``ledger`` evaluates every rule on every document in one pass and keeps the measurements and one bit
per failed rule. A policy is a named mask of rules that must not fail; trying another policy, or
leaving a rule out, reads the ledger only. ``ablations`` first counts documents per pattern of failed
bits (at most 2^rules rows) and answers from those counts.

Words are runs of other characters than blank and \\t-\\r. Measurements of a whole text:
``n_words``; ``word_chars``, code points in words; ``n_symbols``, characters of ``#*$%&|<>``;
``n_lines``, lines with a word; ``n_dup_lines``, those equal to an earlier one; ``n_repeat_words``, words
in 5-word windows found twice or more, the first included; ``n_upper`` and ``n_lower``, letters of Latin
script by case; ``n_exclaim``, exclamation marks.

Defined results: NULL text counts as empty, which fails ``few_words`` alone. Rows are never dropped.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import textblocks as tb
from .frames import append_columns, stored

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower", "n_exclaim",
)
WINDOW = 5

# Rule names and their failure conditions; a rule's bit is its place. New rules go to the end.
RULES = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "100 * n_symbols > 10 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("upper_case", "100 * n_upper > 50 * (n_upper + n_lower)"),
    ("exclamations", "100 * n_exclaim > 50 * n_words"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
)
BITS = {name: 1 << i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version of the decision: documents failing any of ``rules`` go."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[r] for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
STRICT = Policy("2", tuple(BITS))


def _flags(*bytes_: int) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(bytes_)] = True
    return table


_SYMBOLS = _flags(*b"#*$%&|<>")
_EXCLAIM = _flags(*b"!")
_SPACE = _flags(*tb.SEPARATORS)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _with_owner(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    return tb.mix(hashes + tb.mix(owner.astype(np.uint64) + np.uint64(1)))


def _repeat_words(hashes: np.ndarray, bounds: np.ndarray, texts: int) -> np.ndarray:
    windows, window_bounds = tb.window_hashes(hashes, bounds, WINDOW)
    if not len(windows):
        return np.zeros(texts, dtype=np.int64)
    counts = np.diff(window_bounds)
    owner = np.repeat(np.arange(texts), counts)
    position = np.arange(len(windows)) + np.repeat(bounds[:-1] - window_bounds[:-1], counts)
    _, place, times = np.unique(_with_owner(windows, owner), return_inverse=True, return_counts=True)
    found = position[times[place] > 1]
    edges = np.bincount(found, minlength=len(hashes) + 1) - np.bincount(found + WINDOW, minlength=len(hashes) + 1)
    return _per_text(np.cumsum(edges[:-1]) > 0, bounds)


def _lines(block: tb.Block, words: tb.Words) -> tuple[np.ndarray, np.ndarray]:
    """Number of lines with a word, and of those equal to an earlier line, for each text."""
    breaks = np.flatnonzero(block.data == 0x0A)
    filled = block.offsets[:-1][np.diff(block.offsets) > 0]
    starts = np.union1d(filled, breaks[breaks + 1 < len(block.data)] + 1)
    ends = np.concatenate((starts[1:], [len(block.data)])) if len(starts) else starts
    # A line ends before its line break, or where its text does.
    ends = np.where(block.data[np.maximum(ends - 1, 0)] == 0x0A, ends - 1, ends) if len(starts) else ends
    has_word = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[has_word], ends[has_word]
    owner = np.searchsorted(block.offsets, starts, side="right") - 1
    key = _with_owner(tb.span_hashes(block.data, starts, ends), owner)
    _, first = np.unique(key, return_index=True)
    n_lines = np.bincount(owner, minlength=len(block))
    return n_lines, n_lines - np.bincount(owner[first], minlength=len(block))


def _measure(block: tb.Block) -> list[np.ndarray]:
    data, offsets, texts = block.data, block.offsets, len(block)
    words = tb.words(block)
    hashes = tb.span_hashes(data, words.starts, words.ends)
    n_lines, n_dup_lines = _lines(block, words)
    latin = np.zeros(len(data), dtype=np.int8)  # 1 upper, 2 lower: second bytes of U+00C0 to U+00FF
    if len(data) > 1:
        second = np.flatnonzero(data[:-1] == 0xC3) + 1
        kind = data[second]
        latin[second] = np.where(kind < 0x9F, 1, 2) * ((kind != 0x97) & (kind != 0xB7))
    upper = ((data >= 65) & (data <= 90)) | (latin == 1)
    lower = ((data >= 97) & (data <= 122)) | (latin == 2)
    return [
        np.diff(words.bounds),
        _per_text(~_SPACE[data] & ((data & 0xC0) != 0x80), offsets),
        _per_text(_SYMBOLS[data], offsets),
        n_lines,
        n_dup_lines,
        _repeat_words(hashes, words.bounds, texts),
        _per_text(upper, offsets),
        _per_text(lower, offsets),
        _per_text(_EXCLAIM[data], offsets),
    ]


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row with its measurements."""
    def make():
        def compute(batch):
            parts = [_measure(block) for block in tb.blocks(batch.column(text))]
            return [
                pa.array(np.concatenate([p[i] for p in parts]) if parts else np.zeros(0), pa.int64())
                for i in range(len(MEASURES))
            ]

        return compute

    return append_columns(docs, ", ".join(f"{m} long" for m in MEASURES), make)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row with its measurements and ``failed_bits``."""
    bits = F.lit(0)
    for name, fails in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(BITS[name])).otherwise(0))
    return measured(docs, text).withColumn("failed_bits", bits)


def fails(policy: Policy, bits: str = "failed_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask)) != 0


def ablations(entries: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of a policy: documents failing it, failing it alone, and kept if it were left out."""
    patterns = entries.groupBy(F.col("failed_bits").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).alias("bit")) for r in policy.rules]))
    each = patterns.select("bits", "n", rules.alias("r")).select("bits", "n", "r.*")
    without = F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit")))

    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return each.groupBy("rule").agg(
        total(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(F.col("bits") == F.col("bit")).alias("n_failed_alone"),
        total(without == 0).alias("n_kept_without"),
    )


def failures_in_common(entries: DataFrame, by: str) -> DataFrame:
    """Per group the rules that some document fails and those that all documents fail."""
    return entries.groupBy(by).agg(F.bit_or("failed_bits").alias("any_failed"), F.bit_and("failed_bits").alias("all_failed"))


def only_rule(policy: Policy, bits: str = "failed_bits") -> Column:
    """The rule without which the policy would keep a document: the one it fails alone, else NULL."""
    failed = F.col(bits).bitwiseAND(F.lit(policy.mask))
    return F.coalesce(*[F.when(failed == BITS[r], F.lit(r)) for r in policy.rules])


def rule_table(docs: DataFrame) -> DataFrame:
    """Every document's entry with the base decision, the strict policy's, and that policy's ablation.

    The texts are measured once, into a stored ledger; policies and ablations read that table. ``only_rule`` is the rule
    that alone rejects the document, ``kept_without`` the documents the strict policy would keep without it.
    """
    entries = stored(ledger(docs.select("doc_id", "text")).drop("text"), "ledger")
    without = ablations(entries, STRICT).select(F.col("rule").alias("only_rule"), F.col("n_kept_without").alias("kept_without"))
    judged = entries.select(
        "doc_id", *[F.col(m) for m in MEASURES], "failed_bits",
        fails(BASE).alias("base_failed"), (~fails(STRICT)).alias("kept"), only_rule(STRICT).alias("only_rule"),
    )
    # One row per rule of a policy.
    return judged.join(F.broadcast(without), "only_rule", "left").select(*judged.columns, "kept_without")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# Counterpart of ``rule_table`` in DuckDB's SQL, rule by rule.
SQL = rf"""
WITH base AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents
), word AS (
  SELECT row_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM base
), win AS (
  SELECT row_id, pos, word || ' ' || lead(word, 1) OVER w || ' ' || lead(word, 2) OVER w || ' ' || lead(word, 3) OVER w
    || ' ' || lead(word, 4) OVER w AS gram
  FROM word WINDOW w AS (PARTITION BY row_id ORDER BY pos)
), repeated AS (
  SELECT row_id, pos FROM (SELECT row_id, pos, count(*) OVER (PARTITION BY row_id, gram) AS n FROM win WHERE gram IS NOT NULL)
  WHERE n > 1
), covered AS (
  SELECT row_id, count(DISTINCT pos + i) AS n_repeat_words FROM repeated, range(5) AS r(i) GROUP BY row_id
), line AS (
  SELECT row_id, unnest(string_split(text, chr(10))) AS line FROM base
), lines AS (
  SELECT row_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_id
), measured AS (
  SELECT doc_id, len(words) AS n_words, coalesce(length(array_to_string(words, '')), 0) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(regexp_extract_all(text, '[A-ZÀ-ÖØ-Þ]')) AS n_upper, len(regexp_extract_all(text, '[a-zß-öø-ÿ]')) AS n_lower,
    len(regexp_extract_all(text, '!')) AS n_exclaim
  FROM base LEFT JOIN covered USING (row_id) LEFT JOIN lines USING (row_id)
), judged AS (
  SELECT *, {" + ".join(f"(CASE WHEN {fails} THEN {1 << i} ELSE 0 END)" for i, (_, fails) in enumerate(RULES))} AS failed_bits
  FROM measured
)
SELECT doc_id, {", ".join(f"CAST({m} AS BIGINT) AS {m}" for m in MEASURES)}, CAST(failed_bits AS INTEGER) AS failed_bits,
  failed_bits & {BASE.mask} <> 0 AS base_failed, failed_bits & {STRICT.mask} = 0 AS kept, only_rule,
  CASE WHEN only_rule IS NOT NULL THEN count(*) FILTER (WHERE failed_bits & {STRICT.mask} = 0) OVER ()
    + count(*) OVER (PARTITION BY only_rule) END AS kept_without
FROM (SELECT *, CASE failed_bits & {STRICT.mask} {" ".join(f"WHEN {BITS[r]} THEN '{r}'" for r in STRICT.rules)} END AS only_rule FROM judged)
"""
