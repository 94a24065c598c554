"""SQL counterparts of the queries in ``flows``: what the tables must hold, computed in one go."""

from .oracles import ORDER_BY, RULES, _labelled, _merge, customer_360, ts


def _by_layer(entity: str, key: str, column: str, name: str) -> str:
    month = f"strftime(date_trunc('month', {ts(column)}), '%Y-%m-%d')"
    return _merge(_labelled(entity)) + (
        f"SELECT CASE WHEN _dq_issue IS NULL THEN 'silver' ELSE 'dq' END AS layer, ingest_seq, {key}, {month} AS {name}, _dq_issue FROM {entity}_l"
    )


def promotion_checks() -> str:
    checks = ("quarantine_rows_without_issue", "silver_negative_amount", "silver_null_amount", "silver_rows_without_key", "unbalanced_rows")
    counted = [
        f"SELECT 'rule_{label}' AS measure, count(*) FILTER (WHERE {cond}) AS violations FROM payments_p" for label, cond in RULES["payments"]
    ]
    counted += ["SELECT 'total_rows', count(*) FROM payments_l", "SELECT 'invalid_rows', count(*) FROM payments_l WHERE _dq_issue IS NOT NULL"]
    counted += [f"SELECT '{name}', CAST(0 AS BIGINT)" for name in checks]
    return _merge(_labelled("payments")) + " UNION ALL ".join(counted)


_LANDED = """SELECT o_orderkey AS k, year(o_orderdate) AS y, CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderpriority,
 CASE WHEN o_orderkey % 97 = 0 THEN '{"order_id":' || o_orderkey WHEN o_orderkey % 89 = 0 THEN '{"order_id":1,"order_id":' || o_orderkey || '}'
 WHEN o_orderkey % 83 = 0 THEN '[' || o_orderkey || ']' END AS broken, strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS landing_date FROM orders"""


def landing_variant() -> str:
    def kept(value):
        return f"CASE WHEN broken IS NULL THEN {value} END"

    gift = "y >= 1995 AND k % 3 = 0"
    return (
        f"SELECT {kept('k')} AS order_id, {kept('CASE WHEN y < 1997 THEN CAST(price AS DOUBLE) END')} AS total, "
        f"""{kept("CASE WHEN y >= 1997 THEN 'Rs.' || CAST(price AS VARCHAR) END")} AS total_text, """
        f"CASE WHEN broken IS NULL AND {gift} THEN 'note ' || k END AS gift_note, CASE WHEN broken IS NULL AND {gift} THEN k % 2 = 0 END AS gift_wrap, "
        f"{kept('CASE WHEN y >= 1996 THEN o_orderpriority END')} AS priority, broken AS _corrupt_record, landing_date FROM ({_LANDED})"
    )


def landing_unknown_fields() -> str:
    return (
        f"WITH l AS (SELECT * FROM ({_LANDED}) WHERE broken IS NULL) "
        "SELECT 'gift' AS field, 'OBJECT' AS kind, count(*) AS records FROM l WHERE y >= 1995 AND k % 3 = 0 "
        "UNION ALL SELECT 'priority', 'STRING', count(*) FROM l WHERE y >= 1996"
    )


def drift_types() -> str:
    return """WITH o AS (SELECT o_orderkey AS id, year(o_orderdate) AS y, CAST(o_totalprice AS DECIMAL(18,2)) AS p, o_orderpriority FROM orders),
d AS (SELECT *, CASE WHEN y >= 1997 AND id % 53 = 0 THEN 'many' WHEN y >= 1997 AND id % 59 = 0 THEN '1.5' END AS bad_units,
  CASE WHEN y >= 1997 AND id % 61 = 0 THEN 'free' END AS bad_price FROM o)
SELECT id, CASE WHEN bad_units IS NULL THEN CASE WHEN y < 1994 THEN id WHEN y < 1997 THEN id + 10000000000 ELSE id * 10 END END AS units,
  CASE WHEN bad_price IS NULL THEN CAST(p AS DOUBLE) END AS price, CASE WHEN y >= 1997 THEN o_orderpriority END AS priority, bad_units, bad_price FROM d"""


def uniques_rollup() -> str:
    grains = {"day": "strftime(o_orderdate, '%Y-%m-%d')", "all": "'all'"}
    grains |= {g: f"strftime(date_trunc('{g}', o_orderdate), '%Y-%m-%d')" for g in ("week", "month")}
    return " UNION ALL ".join(
        f"SELECT '{g}' AS grain, {period} AS period, count(DISTINCT o_custkey) AS unique_customers FROM orders GROUP BY 2" for g, period in grains.items()
    )


def _broken(entity: str, order: str) -> str:
    """A list of the numbers of broken rules per row."""
    listed = ", ".join(f"CASE WHEN {cond} THEN {i} END" for i, (_, cond) in enumerate(RULES[entity], start=1))
    return f"SELECT {order}, list_filter([{listed}], lambda n: n IS NOT NULL) AS broken FROM {entity}_p"


def rule_cooccurrence() -> str:
    names = ", ".join(f"({i}, '{label}')" for i, (label, _) in enumerate(RULES["orders"], start=1))
    return _merge(_labelled("orders"), [
        f"b AS ({_broken('orders', 'ingest_seq')})", f"names AS (SELECT * FROM (VALUES {names}) AS n(no, label))",
        "one AS (SELECT ingest_seq, len(broken) AS n, unnest(broken) AS no FROM b)",
    ]) + (
        "SELECT x.no AS rule_no, a.label, y.no AS other_no, c.label AS other_label, count(*) AS rows, "
        "count(*) FILTER (WHERE x.n = CASE WHEN x.no = y.no THEN 1 ELSE 2 END) AS only_these FROM one x JOIN one y "
        "ON x.ingest_seq = y.ingest_seq AND x.no <= y.no JOIN names a ON a.no = x.no JOIN names c ON c.no = y.no GROUP BY ALL"
    )


def issues_from_bits() -> str:
    order = ", ".join(ORDER_BY["order_items"])
    labels = ", ".join(f"'{label}'" for label, _ in RULES["order_items"])
    return _merge(_labelled("order_items"), [f"b AS ({_broken('order_items', order)})"]) + (
        f"SELECT {order}, CAST(coalesce(list_sum(list_transform(broken, lambda n: 1 << (n - 1))), 0) AS BIGINT) AS bits, "
        f"[{labels}][broken[1]] AS first_issue, CAST(len(broken) AS INTEGER) AS n_issues FROM b"
    )


def dq_cube() -> str:
    dates = {"customers": "registration_date", "sellers": "joined_date", "products": "created_date", "orders": "order_date"}
    rows = " UNION ALL ".join(
        f"SELECT '{e}' AS entity, strftime({ts(d)}, '%Y-%m') AS month, coalesce(_dq_issue, '(valid)') AS label FROM {e}_l" for e, d in dates.items()
    )
    return _merge(*[_labelled(e) for e in dates], [f"r AS ({rows})"]) + (
        "SELECT concat_ws(',', CASE WHEN grouping(entity) = 0 THEN 'entity' END, CASE WHEN grouping(month) = 0 THEN 'month' END, "
        "CASE WHEN grouping(label) = 0 THEN 'label' END) AS level, entity, month, label, count(*) AS rows FROM r "
        "GROUP BY GROUPING SETS ((entity, month, label), (entity, month), (entity, label), (entity), (month), ())"
    )


def build() -> dict[str, str]:
    by_month = _by_layer("orders", "order_id", "order_date", "order_month")
    return {
        "layers_written": by_month,
        "promotion_checks": promotion_checks(),
        "daily_refresh": by_month,
        "landing_variant": landing_variant(),
        "landing_unknown_fields": landing_unknown_fields(),
        "drift_types": drift_types(),
        "c360_bucketed": customer_360(),
        "uniques_rollup": uniques_rollup(),
        "rule_cooccurrence": rule_cooccurrence(),
        "issues_from_bits": issues_from_bits(),
        "dq_cube": dq_cube(),
    }
