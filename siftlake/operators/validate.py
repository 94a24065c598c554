"""Declarative validation: ordered rules label each row, silver and quarantine split without loss."""

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.predicates import blank
from ..sources.lake import ISSUE
from . import dedup, refs, skew

DUPLICATE = "_duplicate"
# Bits and first label of the broken rules that do not read the duplicate flag.
BROKEN = "_broken"
FIRST_BROKEN = "_first_broken"


@dataclass(frozen=True)
class Rule:
    """A label and a predicate that is true for invalid rows."""

    label: str
    invalid: Column


@dataclass(frozen=True)
class RuleSet:
    """Everything needed to validate one entity.

    Rules are listed in order of precedence. ``derived`` columns are parsed once and used by several
    rules. ``duplicates`` is "later", "all" or None; ``labelling`` is "first" (the first broken rule)
    or "all" (every broken rule, joined with a bar).
    """

    entity: str
    key: str
    columns: tuple[str, ...]
    rules: tuple[Rule, ...]
    derived: dict[str, Column] = field(default_factory=dict)
    lookups: tuple[refs.Lookup, ...] = ()
    duplicates: str | None = "later"
    null_keys: str = "distinct"
    duplicate_key: Column | None = None
    labelling: str = "first"

    @property
    def labels(self) -> list[str]:
        return [r.label for r in self.rules]


def prepare(
    df: DataFrame,
    ruleset: RuleSet,
    references: dict[str, DataFrame] | None = None,
    order_by=None,
    broadcast_rows: int | None = None,
    unique_references: bool = False,
    copies_of: DataFrame | None = None,
    concerned: Column | None = None,
) -> DataFrame:
    """Add the helper columns the rules read: reference attributes, parsed values, duplicate flag; and what ``checked`` reads.

    Rules that do not need the duplicate flag are evaluated before it is attached. So a row takes their bits through the
    shuffle, instead of every column they read, and a filter on the label drops broken rows before it.

    ``copies_of`` may name a frame in which copies are counted instead of ``df``, where ``df`` is a part of it; it needs
    the key and the order columns, and those of ``concerned``, which tells the rows of it that ``df`` may hold. Without ``order_by`` rows have no arrival order: exact copies count as resent, and of the copies of a
    key one is kept. ``broadcast_rows`` and ``unique_references`` are passed on to the duplicate flag and the lookups.
    """
    source = df = df.drop(ISSUE)
    resent = ruleset.duplicates == "later" and order_by is None
    keyed = ruleset.key if ruleset.duplicate_key is None else "_duplicate_key"
    if resent:
        df = _with_key(df, ruleset, keyed)
        df = dedup.flag_resends(df, keyed, DUPLICATE, ruleset.null_keys).drop("_duplicate_key")
    for lookup in ruleset.lookups:
        usable = F.when(~blank(F.col(lookup.column)), refs.as_id(F.col(lookup.column)))
        hot = skew.hot_keys(source, usable)
        df = refs.attach(df, references[lookup.table], lookup, hot, unique_references)
    df = parse_once(df, ruleset.derived)
    early = _early(ruleset)
    if early:
        bits = _bits(ruleset, early)
        df = df.select("*", bits.alias(BROKEN), _lowest(bits, ruleset.labels).alias(FIRST_BROKEN))
    if not ruleset.duplicates or resent:
        return df
    copies_of = _with_key(source if copies_of is None else copies_of, ruleset, keyed)
    df = _with_key(df, ruleset, keyed)
    if ruleset.duplicates == "all":
        df = dedup.flag_all_copies(df, keyed, DUPLICATE, ruleset.null_keys, broadcast_rows, copies_of, source.columns, concerned)
    else:
        df = dedup.flag_later_copies(df, keyed, order_by, DUPLICATE, ruleset.null_keys, broadcast_rows, copies_of, concerned)
    return df.drop("_duplicate_key")


def _with_key(df: DataFrame, ruleset: RuleSet, name: str) -> DataFrame:
    """The frame with the computed key of duplicates, where the rules have one."""
    return df if ruleset.duplicate_key is None else df.withColumn(name, ruleset.duplicate_key)


def _early(ruleset: RuleSet) -> list[int]:
    """Numbers of the rules that ``prepare`` evaluates itself; none where they do not fit a bitmask."""
    if len(ruleset.rules) > MAX_RULES:
        return []
    return [i for i, r in enumerate(ruleset.rules) if DUPLICATE not in str(r.invalid)]


def _bits(ruleset: RuleSet, numbers) -> Column:
    return reduce(Column.bitwiseOR, [F.when(ruleset.rules[i].invalid, F.lit(1 << i)).otherwise(0).cast("bigint") for i in numbers])


def _lowest(bits: Column, labels) -> Column:
    """The label of the lowest set bit, NULL for none.

    It reads the bits once, so that a filter on it can go below them; beside the bits themselves Spark evaluates them once
    for both. Labels found rule by rule would be a second evaluation of every rule.
    """
    return F.get(F.array(*[F.lit(label) for label in labels]), F.instr(F.reverse(F.bin(bits)), "1") - 1)


def checked(ruleset: RuleSet) -> RuleSet:
    """The rules as a prepared frame tells them: those it has evaluated already are read from its bits."""
    early = set(_early(ruleset))
    found = [F.col(BROKEN).bitwiseAND(F.lit(1 << i)) != 0 if i in early else r.invalid for i, r in enumerate(ruleset.rules)]
    return replace(ruleset, rules=tuple(Rule(r.label, c) for r, c in zip(ruleset.rules, found)))


def checked_issue(ruleset: RuleSet) -> Column:
    """``issue`` of a prepared frame."""
    first, *rest = ruleset.rules
    if ruleset.labelling == "first" and rest and _early(ruleset) == list(range(1, len(ruleset.rules))):
        # One case, so that a filter on the label is a filter on both columns.
        return F.when(first.invalid, F.lit(first.label)).otherwise(F.col(FIRST_BROKEN))
    return issue(checked(ruleset))


def parse_once(df: DataFrame, derived: dict[str, Column]) -> DataFrame:
    """Add columns that later filters read as values.

    Plain projected columns would be copied into every predicate above them and parsed again for
    each rule; the output of a generator is computed once per row.
    """
    if not derived:
        return df
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in derived.items()]))))


def first_issue(rules) -> Column:
    """Label of the first broken rule, NULL for a valid row."""
    head, *tail = rules
    chain = F.when(head.invalid, F.lit(head.label))
    return reduce(lambda c, r: c.when(r.invalid, F.lit(r.label)), tail, chain)


def issue_array(rules) -> Column:
    """All broken rules in order, empty for a valid row."""
    return F.array_compact(F.array(*[F.when(r.invalid, F.lit(r.label)) for r in rules]))


def all_issues(rules, separator: str = "|") -> Column:
    """All broken rules joined by a separator, NULL for a valid row."""
    return F.nullif(F.concat_ws(separator, *[F.when(r.invalid, F.lit(r.label)) for r in rules]), F.lit(""))


# Rules of one set; a bit each in a signed 64-bit number.
MAX_RULES = 63


def issue_bits(rules) -> Column:
    """One whole number per row with a bit for every broken rule, the first rule lowest; 0 for a valid row."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules do not fit a bitmask")
    set_bits = [F.when(r.invalid, F.lit(1 << i)).otherwise(0).cast("bigint") for i, r in enumerate(rules)]
    return reduce(Column.bitwiseOR, set_bits)


def issues_of_bits(bits: Column, labels) -> Column:
    """The labels behind a bitmask, in order of the rules."""
    return F.array_compact(F.array(*[F.when(bits.bitwiseAND(F.lit(1 << i)) != 0, F.lit(label)) for i, label in enumerate(labels)]))


def first_issue_of_bits(bits: Column, labels) -> Column:
    """The label of the lowest set bit, NULL for none."""
    return F.try_element_at(issues_of_bits(bits, labels), F.lit(1))


def is_valid(rules) -> Column:
    """True when no rule is broken; never NULL."""
    return ~reduce(lambda a, b: a | b, [F.coalesce(r.invalid, F.lit(False)) for r in rules])


def issue(ruleset: RuleSet) -> Column:
    return all_issues(ruleset.rules) if ruleset.labelling == "all" else first_issue(ruleset.rules)


def validate(df: DataFrame, ruleset: RuleSet, references: dict[str, DataFrame] | None = None, order_by=None) -> DataFrame:
    """All source rows and columns plus the issue label; NULL means valid."""
    columns = [c for c in df.columns if c != ISSUE]
    return label(prepare(df, ruleset, references, order_by), ruleset, columns)


def label(prepared: DataFrame, ruleset: RuleSet, columns) -> DataFrame:
    """Columns of a prepared frame plus the issue label."""
    return prepared.select(*columns, checked_issue(ruleset).alias(ISSUE))


def silver(labelled: DataFrame, columns=None) -> DataFrame:
    """Valid rows with business columns only."""
    rows = labelled.where(F.col(ISSUE).isNull())
    return rows.select(*columns) if columns else rows.drop(ISSUE)


def quarantine(labelled: DataFrame, columns=None) -> DataFrame:
    """Invalid rows with their label."""
    rows = labelled.where(F.col(ISSUE).isNotNull())
    return rows.select(*columns, ISSUE) if columns else rows


def split(labelled: DataFrame, columns=None) -> tuple[DataFrame, DataFrame]:
    """Silver and quarantine; together they hold every input row exactly once."""
    return silver(labelled, columns), quarantine(labelled, columns)
