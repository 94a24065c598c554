"""One entity from raw to silver and quarantine, refreshes of touched days, and the gold marts from silver.

The labelled rows are written once, partitioned by layer: that output is silver and quarantine. Counts and
checks are observed during the same write, so nothing is read again to report on it.
"""

import posixpath
from dataclasses import dataclass, field
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, functions as F

from .. import entities
from ..functions.parsing import number
from ..operators import report, skew
from ..operators.validate import ISSUE, RuleSet, checked, checked_issue, prepare
from ..sources.lake import LANDING, LAYER, NO_VALUE, Lake, in_values, materialize
from . import marts


@dataclass(frozen=True)
class EntityResult:
    """Counts of one run; the tables themselves are in the lake.

    ``checks`` holds what was observed while the layers were written; each is 0 for a sound run.
    ``touched`` lists the periods a refresh replaced.
    """

    total: int
    invalid: int
    rule_counts: dict[str, int]
    checks: dict[str, int] = field(default_factory=dict)
    touched: tuple = ()

    @property
    def valid(self) -> int:
        return self.total - self.invalid


# Repeated keys are broadcast up to this many; a key and its statistics take about 100 bytes.
BROADCAST_KEYS = 1_000_000
# Bronze folders of a period, one for each landing day it has rows of, up to which its rows are taken as lying together.
NEAR_FOLDERS = 2


def _count(condition: Column, name: str) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False))).alias(name)


@dataclass
class _Watched:
    """A labelled frame with its observations: the rows read, the rules, and the rows of each layer."""

    rows: DataFrame
    read: Observation
    rules: Observation
    layers: Observation
    checks: tuple[str, ...]


def _watched(bronze, ruleset, references, order_by, columns, partition, amounts, unique_references, copies_of=None, concerned=None, periods=False) -> _Watched:
    read, rules, layers = Observation("read"), Observation("rules"), Observation("layers")
    seen = bronze.observe(read, F.count(F.lit(1)).alias("rows"))
    copies_of = bronze if copies_of is None else copies_of
    prepared = prepare(seen, ruleset, references, order_by, BROADCAST_KEYS, unique_references, copies_of, concerned)
    label = checked_issue(ruleset)
    prepared = prepared.observe(rules, *report.rule_count_columns(checked(ruleset)))
    layer = F.when(F.col(ISSUE).isNull(), "silver").otherwise("dq")
    labelled = prepared.select(*columns, label.alias(ISSUE), *[c.alias(n) for n, c in partition.items()]).withColumn(LAYER, layer)
    silver, broken = F.col(LAYER) == "silver", F.col(LAYER) == "dq"
    checks = {
        "silver_rows_without_key": silver & F.col(ruleset.key).isNull(),
        "quarantine_rows_without_issue": broken & (F.col(ISSUE) == ""),
        **{f"silver_null_{c}": silver & F.col(c).isNull() for c in amounts},
        **{f"silver_negative_{c}": silver & (number(F.col(c)) < 0) for c in amounts},
    }
    counts = [_count(condition, name) for name, condition in {"silver": silver, "dq": broken, **checks}.items()]
    if periods:
        counts.append(F.collect_set(F.struct(LAYER, *partition)).alias("periods"))
    return _Watched(labelled.observe(layers, *counts), read, rules, layers, tuple(checks))


def _observed(observation: Observation) -> dict:
    """The metrics of a finished write; none where Spark found that a plan has no rows and dropped it whole."""
    try:
        return observation.get
    except Py4JJavaError as error:
        if "AssertionError" not in str(error):
            raise
        return {}


def _result(ruleset: RuleSet, watched: _Watched, touched=()) -> EntityResult:
    rules, layers = _observed(watched.rules), _observed(watched.layers)
    per_rule = {r.label: rules.get(f"rule_{i}", 0) for i, r in enumerate(ruleset.rules, start=1)}
    checks = {n: layers.get(n, 0) for n in watched.checks}
    valid, invalid = layers.get("silver", 0), layers.get("dq", 0)
    # Rows lost or multiplied between the scan and the layers.
    checks["unbalanced_rows"] = abs(_observed(watched.read).get("rows", 0) - valid - invalid)
    return EntityResult(valid + invalid, invalid, per_rule, checks, tuple(touched))


def _near(rows: DataFrame, names) -> bool:
    """Whether rows of one period lie together already: their files are in folders of their own period, and few such folders
    hold one period. Then a task reads few periods, and each file read makes at most one a layer and task."""
    folders = {posixpath.dirname(f) for f in rows.inputFiles()}
    periods = {tuple(part for part in f.split("/") if part.partition("=")[0] in names) for f in folders}
    return all(len(p) == len(names) for p in periods) and len(folders) <= NEAR_FOLDERS * len(periods)


def _gathered(rows: DataFrame, bronze: DataFrame, names) -> DataFrame:
    """Rows ready to be written in partitions of their period, shuffled only where bronze does not hold them so."""
    return rows if _near(bronze, names) else rows.hint("rebalance", LAYER, *names)


def promote(
    lake: Lake,
    ruleset: RuleSet,
    references: dict[str, DataFrame] | None = None,
    order_by=None,
    extra_columns=(),
    unique_references: bool = False,
    schema=None,
    partition: dict[str, Column] | tuple[str, ...] | None = None,
    amounts=(),
) -> EntityResult:
    """Validate bronze and write silver and quarantine in one write.

    ``unique_references`` may be set when the references are silver tables of this lake. ``partition`` names
    partition columns of both layers, computed from the rows, such as the day of a record; their rows
    are rebalanced before the write, so that a day is few files and a large one several tasks. Names alone stand for
    the columns by which ``land`` has partitioned bronze; such rows are written from where they lie, unless the
    folders of a period are many.
    ``amounts`` are columns that silver must hold without NULL and below no zero; violations are observed.
    """
    bronze = lake.read("bronze", ruleset.entity, schema)
    columns, landed = [*ruleset.columns, *extra_columns], isinstance(partition, tuple)
    partition = {name: F.col(name) for name in partition} if landed else partition or {}
    watched = _watched(bronze, ruleset, references, order_by, columns, partition, tuple(amounts), unique_references)
    rows = watched.rows
    if partition:
        rows = _gathered(rows, bronze, tuple(partition)) if landed else rows.hint("rebalance", LAYER, *partition)
    lake.write_validated(rows, ruleset.entity, tuple(partition))
    result = _result(ruleset, watched)
    written = rows.drop(LAYER, *partition).schema
    for layer, n in (("silver", result.valid), ("dq", result.invalid)):
        if not n:
            lake.clear(layer, ruleset.entity, written, "/".join(f"{name}={NO_VALUE}" for name in partition))
    return result


def _periods(rows: DataFrame, names) -> set[tuple]:
    """Values of partition columns; as many as there are days."""
    return {tuple(r) for r in rows.select(*names).distinct().collect()}


def land(
    lake: Lake, ruleset: RuleSet, rows: DataFrame, landing_date: str, period: dict[str, Column], changes: bool = True
) -> DataFrame | None:
    """Put the rows landed on one day into bronze, in partitions of their own period; landing twice replaces.

    Returns a stored table of the periods and keys this changes: those of the new rows and of replaced ones. It takes
    another evaluation of ``rows``; without ``changes`` there is none, for a landing that a full run follows.
    """
    named = rows.drop(LANDING).withColumns(period)
    if not changes:
        lake.land(named, ruleset.entity, landing_date, list(period))
        return None
    changed = named.select(ruleset.key, *period)
    if lake.has("bronze", ruleset.entity):
        before = lake.read("bronze", ruleset.entity).where(F.col(LANDING) == F.lit(landing_date).cast("date"))
        changed = changed.unionByName(before.select(ruleset.key, *period))
    changed = materialize(changed.distinct(), "changed")
    lake.land(named, ruleset.entity, landing_date, list(period))
    return changed


def refresh(
    lake: Lake,
    ruleset: RuleSet,
    changed: DataFrame,
    period: str,
    references: dict[str, DataFrame] | None = None,
    order_by=None,
    extra_columns=(),
    unique_references: bool = False,
    amounts=(),
) -> EntityResult:
    """Validate the periods that ``changed`` touches and replace their partitions of silver and quarantine.

    ``changed`` comes from ``land`` (several may be united). A late or resent record may take the place of the first
    copy of its key, so periods that hold another copy of a changed key are touched as well. Duplicates are
    judged against all of bronze, of which only key and order columns are read: the keys of few touched rows are
    broadcast, else all keys are aggregated once. The touched rows are shuffled only where they do not lie together.
    Every other partition, and its files, stays. References must be those of the last full run: if they
    change, tables that look them up are promoted anew.
    """
    bronze = lake.read("bronze", ruleset.entity)
    columns = [*ruleset.columns, *extra_columns]
    keys = changed.where(F.col(ruleset.key).isNotNull()).select(F.col(ruleset.key).alias("_changed")).distinct()
    keys = skew.bounded_broadcast(keys, BROADCAST_KEYS)
    shared = bronze.join(keys, F.col(ruleset.key) == F.col("_changed"), "left_semi")
    touched = sorted(_periods(changed, [period]) | _periods(shared, [period]), key=lambda t: str(t[0]))
    values = [t[0] for t in touched]
    if not values:
        return EntityResult(0, 0, {r.label: 0 for r in ruleset.rules})
    rows = bronze.where(in_values(period, values))
    names = [ruleset.key, *([order_by] if isinstance(order_by, str) else order_by or [])]
    copies, concerned = bronze.select(*dict.fromkeys([*names, period])), None
    if rows.count() <= BROADCAST_KEYS:
        present = rows.where(F.col(ruleset.key).isNotNull()).select(F.col(ruleset.key).alias("_present")).distinct()
        copies = copies.drop(period).join(F.broadcast(present), F.col(ruleset.key) == F.col("_present"), "left_semi")
    else:
        concerned = F.coalesce(in_values(period, values), F.lit(False))
    watched = _watched(
        rows, ruleset, references, order_by, columns, {period: F.col(period)}, tuple(amounts), unique_references, copies, concerned, periods=True
    )
    lake.write_validated(_gathered(watched.rows, bronze, (period,)), ruleset.entity, (period,), only_touched=True)
    written = {(r[LAYER], r[period]) for r in _observed(watched.layers).get("periods", ())}
    schema = watched.rows.drop(LAYER, period).schema
    for layer in ("silver", "dq"):
        existing = {p[0] for p in _periods(lake.read(layer, ruleset.entity).where(in_values(period, values)), [period])}
        for value in existing - {v for name, v in written if name == layer}:
            # The layer had rows of a touched period and has none any more.
            folder = NO_VALUE if value is None else value
            lake.clear(layer, ruleset.entity, schema, f"{period}={folder}")
    return _result(ruleset, watched, values)


def rule_sets(as_of, **parameters) -> list[RuleSet]:
    """Rule sets of all entities, references before the tables that use them.

    ``parameters`` maps an entity to the arguments of its rule set, such as ids of another range:
    ``orders={"max_customer": None}``.
    """
    builders = {
        "customers": partial(entities.customers, as_of),
        "sellers": partial(entities.sellers, as_of),
        "products": partial(entities.products_strict, as_of),
        "orders": partial(entities.orders, as_of),
        "order_items": entities.order_items,
        "payments": partial(entities.payments, as_of),
        "inventory": partial(entities.inventory, as_of),
    }
    if unknown := set(parameters) - set(builders):
        raise ValueError(f"no such entity: {sorted(unknown)}")
    return [build(**parameters.get(entity, {})) for entity, build in builders.items()]


def promote_all(lake: Lake, as_of, order_by=None, **parameters) -> dict[str, EntityResult]:
    """Every entity from raw to silver and quarantine; ``parameters`` as for ``rule_sets``."""
    results = {}
    for ruleset in rule_sets(as_of, **parameters):
        lake.copy(ruleset.entity)
        references = {lookup.table: lake.read("silver", lookup.table) for lookup in ruleset.lookups}
        results[ruleset.entity] = promote(lake, ruleset, references, order_by)
    return results


def build_marts(lake: Lake) -> None:
    """Write both gold marts from the silver tables."""
    t = lake.read_all("silver", ("customers", "orders", "order_items", "payments"))
    c360 = marts.customer_360(t["customers"], t["orders"], t["order_items"], t["payments"], ordered=False)
    lake.write(c360, "gold", "customer_360")
    daily = marts.daily_sales(t["orders"], t["order_items"], t["payments"], item_ids_unique=True, ordered=False)
    lake.write(daily, "gold", "daily_sales")
