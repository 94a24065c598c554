"""Quality reports. Counts over the same rows share one aggregation."""

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.lake import materialize
from .validate import ISSUE, RuleSet, checked, checked_issue, issue_bits, prepare


def _long(row: DataFrame, names: list[str], columns: list[str], first: str, value: str, numbered: bool = False) -> DataFrame:
    """Turn one wide row of counts into one row per count."""
    items = []
    for i, (name, column) in enumerate(zip(names, columns), start=1):
        fields = [F.lit(name).alias(first), F.col(column).alias(value)]
        items.append(F.struct(F.lit(i).alias("rule_no"), *fields) if numbered else F.struct(*fields))
    return row.select(F.inline(F.array(*items)))


def rule_count_columns(ruleset: RuleSet) -> list[Column]:
    """Total rows and one count per rule, each rule on its own."""
    return [F.count(F.lit(1)).alias("rows")] + [
        F.count_if(r.invalid).alias(f"rule_{i}") for i, r in enumerate(ruleset.rules, start=1)
    ]


def rule_counts(prepared: DataFrame, ruleset: RuleSet) -> DataFrame:
    """Violations per rule in one pass over a prepared frame."""
    wide = prepared.agg(*rule_count_columns(ruleset))
    columns = [f"rule_{i}" for i in range(1, len(ruleset.rules) + 1)]
    return _long(wide, ruleset.labels, columns, "label", "violations", numbered=True)


def totals(labelled: DataFrame) -> DataFrame:
    """Total, valid and invalid rows."""
    valid = F.col(ISSUE).isNull()
    return labelled.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(valid).alias("valid_rows"),
        F.count_if(~valid).alias("invalid_rows"),
    )


def issue_distribution(labelled: DataFrame) -> DataFrame:
    """Rows per label, most frequent first."""
    counts = labelled.where(F.col(ISSUE).isNotNull()).groupBy(ISSUE).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), ISSUE)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; NULL is left out."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), column)


def filter_counts(df: DataFrame, kept: Column) -> DataFrame:
    """How many rows a filter keeps and drops."""
    kept = F.coalesce(kept, F.lit(False))
    return df.agg(F.count_if(kept).alias("included"), F.count_if(~kept).alias("excluded"))


def _profile(df: DataFrame, columns: list[str], test, value: str) -> DataFrame:
    wide = df.agg(*[F.count_if(test(F.col(c))).alias(f"n_{i}") for i, c in enumerate(columns)])
    return _long(wide, columns, [f"n_{i}" for i in range(len(columns))], "column_name", value)


def null_profile(df: DataFrame, columns=None) -> DataFrame:
    """NULLs per column."""
    return _profile(df, list(columns or df.columns), lambda c: c.isNull(), "null_count")


def negative_profile(df: DataFrame, columns) -> DataFrame:
    """Negative values per column."""
    return _profile(df, list(columns), lambda c: c < 0, "negative_count")


def repeated_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their number of copies."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def repeated_key_summary(df: DataFrame, keys) -> DataFrame:
    """Number of repeated keys and of rows beyond the first copy."""
    return repeated_keys(df, keys).agg(
        F.count(F.lit(1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("extra_rows"),
    )


def preview(df: DataFrame, order_by, n: int = 10) -> DataFrame:
    """First ``n`` rows in a total order."""
    columns = order_by if isinstance(order_by, (list, tuple)) else [order_by]
    return df.orderBy(*columns).limit(n)


def check_rules(df: DataFrame, ruleset: RuleSet, references=None, order_by=None) -> DataFrame:
    """Re-apply a rule set; silver is expected to show zero for every rule."""
    return rule_counts(prepare(df, ruleset, references, order_by), checked(ruleset))


def check_layers(silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Layer invariants as (check, violations): label absent in silver, present and never NULL in quarantine."""
    shape = int(ISSUE in silver.columns), int(ISSUE not in quarantine.columns)
    unlabelled = F.lit(0).cast("bigint") if shape[1] else F.count_if(F.col(ISSUE).isNull())
    wide = quarantine.agg(
        F.lit(shape[0]).cast("bigint").alias("a"), F.lit(shape[1]).cast("bigint").alias("b"), unlabelled.alias("c")
    )
    names = ["issue_column_in_silver", "issue_column_missing_in_quarantine", "quarantine_rows_without_issue"]
    return _long(wide, names, ["a", "b", "c"], "check", "violations")


def check_mart(mart: DataFrame, key: str, money_columns, required=None) -> DataFrame:
    """Mart invariants as (check, violations): repeated keys, NULLs of required columns, negative amounts.

    The mart is read once: its counts are summed per key and then over all keys.
    """
    money_columns, required = list(money_columns), list(required or [key])
    flags = [F.col(c).isNull() for c in required] + [F.col(c) < 0 for c in money_columns]
    per_key = mart.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(x).alias(f"_n{i}") for i, x in enumerate(flags)])
    wide = per_key.agg(
        F.count_if(F.col("_rows") > 1).alias("r"),
        *[F.coalesce(F.sum(f"_n{i}"), F.lit(0)).alias(f"n_{i}") for i in range(len(flags))],
    )
    names = [f"repeated_{key}"] + [f"null_{c}" for c in required] + [f"negative_{c}" for c in money_columns]
    return _long(wide, names, ["r"] + [f"n_{i}" for i in range(len(flags))], "check", "violations")


def schema_report(df: DataFrame):
    """Column names and types, in order, as plain pairs."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def summary(df: DataFrame, ruleset: RuleSet, references=None, order_by=None) -> dict[str, DataFrame]:
    """Rule counts, totals and label distribution of one entity, from one validation.

    Rows are validated and grouped by label once; the small stored result answers all three.
    """
    prepared = prepare(df, ruleset, references, order_by)
    grouped = prepared.groupBy(checked_issue(ruleset).alias(ISSUE)).agg(*rule_count_columns(checked(ruleset)))
    grouped = materialize(grouped, "summary")
    columns = [f"rule_{i}" for i in range(1, len(ruleset.rules) + 1)]
    wide = grouped.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])
    valid, rows = F.col(ISSUE).isNull(), F.col("rows")

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, rows)), F.lit(0))

    return {
        "rule_counts": _long(wide, ruleset.labels, columns, "label", "violations", numbered=True),
        "totals": grouped.agg(
            total(F.lit(True)).alias("total_rows"), total(valid).alias("valid_rows"), total(~valid).alias("invalid_rows")
        ),
        "distribution": grouped.where(~valid).select(ISSUE, rows.alias("count")).orderBy(F.desc("count"), ISSUE),
    }


def bit_patterns(prepared: DataFrame, ruleset: RuleSet) -> DataFrame:
    """bits, rows: how often each combination of broken rules occurs. Every report on rules can be read from it."""
    return prepared.groupBy(issue_bits(ruleset.rules).alias("bits")).agg(F.count(F.lit(1)).alias("rows"))


def cooccurrence(patterns: DataFrame, ruleset: RuleSet) -> DataFrame:
    """Rows that break two rules together, for every such pair in order; a rule with itself gives all its rows.

    ``only_these`` counts the rows that break no other rule.
    """
    bits = F.col("bits")
    numbers = F.array_compact(F.array(*[F.when(bits.bitwiseAND(F.lit(1 << i)) != 0, F.lit(i + 1)) for i in range(len(ruleset.rules))]))
    first = patterns.where(bits != 0).select("bits", "rows", numbers.alias("_numbers")).select("*", F.explode("_numbers").alias("rule_no"))
    both = first.select("*", F.explode(F.filter("_numbers", lambda n: n >= F.col("rule_no"))).alias("other_no"))
    pair = F.when(F.col("rule_no") == F.col("other_no"), 1).otherwise(2)
    only = F.sum(F.when(F.size("_numbers") == pair, F.col("rows")).otherwise(0)).alias("only_these")
    summed = both.groupBy("rule_no", "other_no").agg(F.sum("rows").alias("rows"), only)
    names = F.array(*[F.lit(label) for label in ruleset.labels])
    return summed.select(
        "rule_no", F.element_at(names, F.col("rule_no")).alias("label"), "other_no", F.element_at(names, F.col("other_no")).alias("other_label"),
        "rows", "only_these",
    )


VALID_LABEL = "(valid)"


def issue_cube(labelled: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Rows by entity, month and label with all totals; ``labelled`` maps an entity to its labelled rows and their date.

    Each table is counted once by (month, label); grouping sets run over those counts. Columns that a total runs
    over are NULL; ``level`` names the set, as a row without a date has month NULL too. Valid rows count as ``(valid)``.
    """
    counts = None
    for entity, (rows, date) in labelled.items():
        month = F.date_format(F.trunc(date, "month"), "yyyy-MM")
        label = F.coalesce(F.col(ISSUE), F.lit(VALID_LABEL))
        one = rows.select(F.lit(entity).alias("entity"), month.alias("month"), label.alias("label"))
        one = one.groupBy("entity", "month", "label").agg(F.count(F.lit(1)).alias("_rows"))
        counts = one if counts is None else counts.unionByName(one)
    columns = ["entity", "month", "label"]
    sets = [columns, ["entity", "month"], ["entity", "label"], ["entity"], ["month"], []]
    cube = counts.groupingSets([[F.col(c) for c in s] for s in sets], *columns)
    kept = [F.when(F.grouping(c) == 0, F.lit(c)) for c in columns]
    total = cube.agg(F.concat_ws(",", *kept).alias("level"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"))
    return total.select("level", *columns, "rows")
