"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL follows the plain relational definition of each model, not the
Spark plan: e.g. client totals join every transaction to its account before
grouping, where the Spark model pre-aggregates per account. Both sides apply
the same crosswalk from the driver's tables (``ledgerlake.sources.crosswalk``).

Output types are normalized the same way as :func:`ledgerlake.plans.registry.comparable`:
integers as BIGINT, exact numerics as DOUBLE (converted once, at the end).
Rounded ratios are computed with exact integer arithmetic because DuckDB
divides decimals in floating point, which rounds some halves the wrong way.
"""

from __future__ import annotations

# --- exact arithmetic helpers (emit SQL text) --------------------------------


def rr(num: str, den: str, digits: int, factor: int = 1) -> str:
    """round(num * factor / den, digits), half away from zero, exact; NULL if den = 0.

    ``num`` and ``den`` are integer expressions.
    """
    scale = 10 ** digits
    n = f"(CAST({num} AS HUGEINT) * {factor * scale})"
    d = f"CAST({den} AS HUGEINT)"
    m = f"(sign({n}) * ((abs({n}) * 2 + {d}) // (2 * {d})))"
    unit = f"CAST(0.{'0' * (digits - 1)}1 AS DECIMAL({digits},{digits}))" if digits else "1"
    return f"(CASE WHEN {d} = 0 THEN NULL ELSE CAST({m} AS DECIMAL(36,0)) * {unit} END)"


def ravg_decimal(x: str, in_scale: int, out_scale: int) -> str:
    """Mean of a decimal column rounded half away from zero to ``out_scale`` digits, exact."""
    up = 10 ** (out_scale - in_scale)
    s = f"CAST(sum({x}) * {10 ** in_scale} AS HUGEINT)"
    n = f"CAST(count({x}) AS HUGEINT)"
    num = f"({s} * {up})"
    m = f"(sign({num}) * ((abs({num}) * 2 + {n}) // (2 * {n})))"
    unit = f"CAST(0.{'0' * (out_scale - 1)}1 AS DECIMAL({out_scale},{out_scale}))"
    return f"(CASE WHEN {n} = 0 THEN NULL ELSE CAST({m} AS DECIMAL(26,0)) * {unit} END)"


# --- staging over the driver tables -----------------------------------------

STATUS_CASE = ("CASE l_returnflag WHEN 'R' THEN CASE WHEN l_quantity > 45 THEN 'Aprovada' "
               "ELSE 'Validação documentos' END WHEN 'A' THEN 'Em análise' "
               "WHEN 'N' THEN 'Enviada' END")

CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "stg_agencies": ((), """
        SELECT CAST(n.n_nationkey AS BIGINT) AS agency_id, n.n_name AS agency_name,
               CAST(NULL AS VARCHAR) AS address, CAST(NULL AS VARCHAR) AS city,
               CAST(NULL AS VARCHAR) AS state, CAST(NULL AS DATE) AS opening_date,
               r.r_name AS agency_type
        FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    "stg_clients": ((), """
        SELECT c.c_custkey AS client_id,
               regexp_extract(c.c_name, '^([^#]*)', 1) || ' ' || regexp_extract(c.c_name, '#(.*)$', 1)
                   AS client_full_name,
               CAST(NULL AS VARCHAR) AS email, c.c_mktsegment AS client_type,
               fo.first_order_at AS onboarding_date, CAST(NULL AS VARCHAR) AS cpf_cnpj,
               CAST(NULL AS DATE) AS birth_date, CAST(NULL AS VARCHAR) AS address,
               CAST(NULL AS VARCHAR) AS postal_code
        FROM customer c
        LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order_at FROM orders GROUP BY o_custkey) fo
            ON c.c_custkey = fo.o_custkey"""),
    "stg_employees": ((), """
        SELECT s_suppkey AS employee_id, s_name AS first_name, CAST(NULL AS VARCHAR) AS last_name,
               CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS cpf,
               CAST(NULL AS DATE) AS birth_date, CAST(NULL AS VARCHAR) AS address,
               CAST(NULL AS VARCHAR) AS postal_code
        FROM supplier"""),
    "stg_employee_agency": ((), """
        SELECT s_suppkey AS employee_id, CAST(s_nationkey AS BIGINT) AS agency_id FROM supplier"""),
    "stg_accounts": ((), """
        SELECT o.o_orderkey AS account_id, o.o_custkey AS client_id,
               CAST(c.c_nationkey AS BIGINT) AS agency_id, CAST(NULL AS BIGINT) AS employee_id,
               o.o_orderpriority AS account_type, o.o_orderdate AS opening_date,
               CAST(o.o_totalprice AS DECIMAL(18,2)) AS total_balance,
               CAST(NULL AS DECIMAL(18,2)) AS available_balance,
               CAST(NULL AS TIMESTAMP) AS last_posting_date
        FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""),
    "stg_proposals": ((), f"""
        SELECT l.l_orderkey * 10 + l.l_linenumber AS proposal_id, o.o_custkey AS client_id, l.l_suppkey AS employee_id,
               l.l_shipdate AS proposal_date,
               CAST(l.l_discount AS DECIMAL(18,8)) AS monthly_interest_rate,
               CAST(l.l_extendedprice AS DECIMAL(18,2)) AS proposal_amount,
               CAST(NULL AS DECIMAL(18,2)) AS financing_amount,
               CAST(NULL AS DECIMAL(18,2)) AS down_payment,
               CAST(NULL AS DECIMAL(18,2)) AS installment_amount,
               CAST(NULL AS INTEGER) AS installment_count, CAST(NULL AS INTEGER) AS grace_period,
               {STATUS_CASE} AS proposal_status
        FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey"""),
    "stg_transactions": ((), """
        SELECT l_orderkey * 10 + l_linenumber AS transaction_id, l_orderkey AS account_id,
               l_shipdate AS transaction_at, l_returnflag AS transaction_type,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS transaction_amount
        FROM lineitem"""),
    "stg_transactions_events": ((), """
        SELECT event_id AS transaction_id, user_id AS account_id, ts AS transaction_at,
               event_type AS transaction_type, CAST(value AS DECIMAL(18,2)) AS transaction_amount
        FROM events"""),
}


def _mart(name: str, deps: tuple[str, ...], sql: str) -> None:
    CTE[name] = (deps, sql)


_REF = "(SELECT CAST(max(transaction_at) AS DATE) FROM stg_transactions)"


def band_join(rows: str, bands: tuple[tuple[int, int, str], ...]) -> str:
    """``rows`` (with ``days``) joined to the band of days, ends included; -1 stands for NULL."""
    table = ", ".join(f"({low}, {high}, '{label}')" for low, high, label in bands)
    return (f"({rows}) u JOIN (VALUES {table}) band(low, high, label) "
            f"ON coalesce(u.days, -1) BETWEEN band.low AND band.high")


_FAR = 10 ** 8
_mart("account_activity", ("stg_accounts", "stg_transactions"), f"""
    SELECT u.account_id AS account_sk, u.client_id AS client_fk, u.agency_id AS agency_fk,
           u.total_balance, u.last_day AS last_transaction_date,
           u.days AS days_since_last_transaction, band.label AS activity_status
    FROM {band_join(f"""
        SELECT a.*, used.last_day, {_REF} - used.last_day AS days
        FROM stg_accounts a,
             LATERAL (SELECT CAST(max(t.transaction_at) AS DATE) AS last_day
                      FROM stg_transactions t WHERE t.account_id = a.account_id) used""",
        ((-1, -1, "never_used"), (0, 90, "active"), (91, _FAR, "dormant")))}""")

_mart("credit_funnel", ("stg_proposals",), f"""
    SELECT date_trunc('month', p.proposal_date) AS month, p.proposal_status,
           count(*) AS proposal_count,
           sum(p.proposal_amount) AS total_proposal_amount,
           {ravg_decimal('p.monthly_interest_rate', 8, 12)} AS avg_interest_rate
    FROM stg_proposals p
    GROUP BY ALL""")

_APPROVED_01 = "count(*) FILTER (WHERE x.proposal_status = 'Aprovada')"
_mart("agency_performance", ("stg_agencies", "stg_employee_agency", "stg_proposals"), f"""
    SELECT ag.agency_id AS agency_sk, ag.agency_name, ag.agency_type,
           count(x.proposal_id) AS total_proposals,
           {_APPROVED_01} AS approved_proposals,
           {rr(_APPROVED_01, 'count(x.proposal_id)', 2, 100)} AS conversion_rate_pct,
           sum(x.proposal_amount) AS total_proposal_amount
    FROM stg_agencies ag
    LEFT JOIN (SELECT b.agency_id, p.proposal_id, p.proposal_status, p.proposal_amount
               FROM stg_employee_agency b JOIN stg_proposals p ON p.employee_id = b.employee_id) x
           ON x.agency_id = ag.agency_id
    GROUP BY ag.agency_id, ag.agency_name, ag.agency_type""")


def _daily_volume(tx: str) -> str:
    return f"""
    SELECT d AS transaction_date, transaction_type, n AS transaction_count,
           accounts AS distinct_accounts, {rr('n', 'accounts', 2)} AS avg_tx_per_account
    FROM (SELECT CAST(transaction_at AS DATE) AS d, transaction_type, count(*) AS n,
                 count(DISTINCT account_id) AS accounts
          FROM {tx} GROUP BY ALL) v"""


_mart("daily_volume", ("stg_transactions",), _daily_volume("stg_transactions"))
_mart("daily_volume_events", ("stg_transactions_events",), _daily_volume("stg_transactions_events"))

_mart("client_engagement", ("stg_clients", "stg_accounts", "stg_transactions", "stg_proposals"), f"""
    SELECT u.client_id AS client_sk, u.client_full_name, u.client_type,
           u.since AS onboarding_date, u.accounts AS account_count, u.balance AS total_balance,
           u.moves AS transaction_count, u.moved AS transaction_total_amount,
           {rr('u.moves', 'u.accounts', 2)} AS avg_tx_per_account,
           u.last_day AS last_transaction_date, u.days AS days_since_last_transaction,
           {_REF} - u.since AS relationship_days, u.approvals > 0 AS has_approved_credit,
           band.label AS engagement_status
    FROM {band_join(f"""
        SELECT c.client_id, c.client_full_name, c.client_type,
               CAST(c.onboarding_date AS DATE) AS since, held.accounts, held.balance,
               used.moves, used.moved, used.last_day, {_REF} - used.last_day AS days,
               asked.approvals
        FROM stg_clients c,
             LATERAL (SELECT count(*) AS accounts, sum(a.total_balance) AS balance
                      FROM stg_accounts a WHERE a.client_id = c.client_id) held,
             LATERAL (SELECT count(t.transaction_id) AS moves,
                             coalesce(sum(t.transaction_amount), 0) AS moved,
                             CAST(max(t.transaction_at) AS DATE) AS last_day
                      FROM stg_accounts a JOIN stg_transactions t ON t.account_id = a.account_id
                      WHERE a.client_id = c.client_id) used,
             LATERAL (SELECT count(*) AS approvals FROM stg_proposals p
                      WHERE p.client_id = c.client_id AND p.proposal_status = 'Aprovada') asked
        WHERE held.accounts > 0""",
        ((-1, -1, "never_used"), (0, 90, "active"), (91, 360, "at_risk"), (361, _FAR, "churned")))}""")

_mart("commercial_kpis", ("client_engagement",), f"""
    SELECT n AS total_clientes, active AS clientes_ativos, risk AS clientes_em_risco,
           churned AS clientes_churned, unused AS clientes_sem_uso,
           {rr('active', 'n', 2, 100)} AS taxa_ativos_pct,
           {rr('risk + churned', 'n', 2, 100)} AS taxa_inativos_pct,
           {rr('tx', 'n_tx', 2)} AS media_transacoes_por_cliente,
           {rr('credit', 'n', 2, 100)} AS taxa_posse_credito_pct
    FROM (SELECT count(*) AS n,
                 count_if(engagement_status = 'active') AS active,
                 count_if(engagement_status = 'at_risk') AS risk,
                 count_if(engagement_status = 'churned') AS churned,
                 count_if(engagement_status = 'never_used') AS unused,
                 count_if(has_approved_credit) AS credit,
                 sum(transaction_count) AS tx, count(transaction_count) AS n_tx
          FROM client_engagement) k""")

_mart("credit_kpis", ("credit_funnel",), f"""
    SELECT total AS total_proposals, ok AS approved_proposals, other AS rejected_proposals,
           {rr('ok', 'total', 2, 100)} AS approval_rate_pct,
           round(amount, 2) AS total_proposal_amount, round(ok_amount, 2) AS total_financed_amount,
           round(mean_rate * 100, 4) AS avg_interest_rate_pct
    FROM (SELECT sum(proposal_count) AS total,
                 coalesce(sum(proposal_count) FILTER (WHERE proposal_status = 'Aprovada'), 0) AS ok,
                 coalesce(sum(proposal_count) FILTER (WHERE proposal_status <> 'Aprovada'), 0) AS other,
                 sum(total_proposal_amount) AS amount,
                 coalesce(sum(total_proposal_amount) FILTER (WHERE proposal_status = 'Aprovada'), 0)
                     AS ok_amount,
                 avg(avg_interest_rate) AS mean_rate
          FROM credit_funnel) f""")

_mart("cross_sell", ("stg_accounts", "stg_clients", "stg_proposals"), """
    SELECT c.client_id AS client_fk, c.client_full_name, a.account_id AS account_fk,
           a.total_balance, a.agency_id AS agency_fk
    FROM stg_accounts a
    JOIN stg_clients c ON c.client_id = a.client_id
    WHERE a.total_balance > 20000
      AND NOT EXISTS (SELECT 1 FROM stg_proposals p
                      WHERE p.client_id = a.client_id AND p.proposal_status = 'Aprovada')""")


_DRIVERS = (("saldo_total", "CAST(total_balance AS DOUBLE)"),
            ("tempo_relacionamento", "CAST(relationship_days AS DOUBLE)"),
            ("quantidade_contas", "CAST(account_count AS DOUBLE)"),
            ("posse_credito_aprovado", "CASE WHEN has_approved_credit THEN 1.0 ELSE 0.0 END"))


def driver_ranking_sql(drivers: tuple[tuple[str, str], ...] = _DRIVERS) -> str:
    """Ranking of ``(name, SQL expression over client_engagement)`` drivers.

    One row per client and driver; Pearson's r from sums of centred products.
    """
    pairs = ", ".join(f"{{'driver': '{name}', 'x': CAST({expr} AS DOUBLE)}}"
                      for name, expr in drivers)
    return f"""
    WITH observed AS (
        SELECT d.driver, d.x, y, n
        FROM (SELECT unnest([{pairs}]) AS d, CAST(transaction_count AS DOUBLE) AS y,
                     count(*) OVER () AS n
              FROM client_engagement) e),
    centred AS (
        SELECT driver, n, x - avg(x) OVER w AS dx, y - avg(y) OVER w AS dy,
               min(x) OVER w < max(x) OVER w AND min(y) OVER w < max(y) OVER w AS varies
        FROM observed WHERE x IS NOT NULL AND y IS NOT NULL
        WINDOW w AS (PARTITION BY driver)),
    related AS (
        SELECT driver, max(n) AS n, sum(dx * dy) / sqrt(sum(dx * dx) * sum(dy * dy)) AS r
        FROM centred WHERE varies GROUP BY driver)
    SELECT driver,
           round(CAST(r AS DECIMAL(38,18)), 4) AS correlation,
           round(CAST(abs(r) AS DECIMAL(38,18)), 4) AS abs_correlation,
           round(CAST(r * r * 100 AS DECIMAL(38,18)), 2) AS r_squared_pct,
           list_extract(['negativo', 'indefinido', 'positivo'], 2 + CAST(sign(r) AS INTEGER))
               AS direction,
           n AS sample_size,
           round(CAST(r / sqrt((1 - r * r) / (n - 2)) AS DECIMAL(38,18)), 2) AS t_statistic,
           abs(r) > 1.96 * sqrt((1 - r * r) / (n - 2)) AS significant_at_5pct,
           rank() OVER (ORDER BY abs(r) DESC, driver) AS impact_rank
    FROM related"""


_mart("driver_ranking", ("client_engagement",), driver_ranking_sql())


def with_extra_cte(sql: str, name: str, body: str) -> str:
    """Insert one more CTE right before the final SELECT of a ``with_ctes`` query."""
    head, _, final = sql.rpartition("\nSELECT ")
    return f"{head},\n{name} AS ({body}\n)\nSELECT {final}"


def with_ctes(body: str, *roots: str, rename: dict[str, str] | None = None) -> str:
    """``WITH`` every model ``roots`` needs (dependencies first), then ``body``.

    ``rename`` maps a model name to the CTE that should stand in for it
    (e.g. the events-based transactions instead of the lineitem ones).
    """
    rename = rename or {}
    order: list[str] = []

    def visit(name: str) -> None:
        target = rename.get(name, name)
        deps, _ = CTE[target]
        for dep in deps:
            visit(dep)
        if name not in order:
            order.append(name)

    for root in roots:
        visit(root)
    parts = [f"{name} AS ({CTE[rename.get(name, name)][1]}\n)" for name in order]
    return "WITH " + ",\n".join(parts) + "\n" + body


# --- live quality dashboard and generic checks ---------------------------------

def _orphans(model: str, noun: str) -> str:
    return f"""
        SELECT '{model}' AS model_name, 'client_id' AS column_name, 'relationships' AS test_type,
               CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
               count(*) AS failure_count,
               'Found ' || count(*) || ' {noun}(s) referencing non-existent client(s)' AS message
        FROM {model} c LEFT JOIN stg_clients cl ON c.client_id = cl.client_id
        WHERE cl.client_id IS NULL"""


def _nulls(model: str, key: str) -> str:
    return f"""
        SELECT '{model}' AS model_name, '{key}' AS column_name, 'not_null' AS test_type,
               CASE WHEN count(*) FILTER (WHERE {key} IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
               count(*) FILTER (WHERE {key} IS NULL) AS failure_count,
               'null check on {key}' AS message
        FROM {model}"""


def _dups(model: str, key: str) -> str:
    return f"""
        SELECT '{model}' AS model_name, '{key}' AS column_name, 'unique' AS test_type,
               CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
               count(*) AS failure_count, 'uniqueness check on {key}' AS message
        FROM (SELECT {key} FROM {model} GROUP BY {key} HAVING count(*) > 1) dup"""


_KEYS = (("stg_clients", "client_id"), ("stg_agencies", "agency_id"),
         ("stg_proposals", "proposal_id"), ("stg_accounts", "account_id"))
_mart("quality_dashboard", ("stg_clients", "stg_agencies", "stg_accounts", "stg_proposals"),
      "\n UNION ALL ".join([_orphans("stg_accounts", "account"), _orphans("stg_proposals", "proposal")]
                           + [_nulls(m, k) for m, k in _KEYS] + [_dups(m, k) for m, k in _KEYS]))


def sql_literal(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def check_count_sql(check) -> str:
    """Failing-record count of one generic test, in the usual data-test SQL."""
    m, c = check.model, check.column
    if check.kind == "not_null":
        return f"SELECT count(*) FROM {m} WHERE {c} IS NULL"
    if check.kind == "unique":
        return (f"SELECT count(*) FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL "
                f"GROUP BY {c} HAVING count(*) > 1) t")
    if check.kind == "unique_combination":
        cols = ", ".join(check.columns)
        return f"SELECT count(*) FROM (SELECT {cols} FROM {m} GROUP BY {cols} HAVING count(*) > 1) t"
    if check.kind == "accepted_values":
        vals = ", ".join(sql_literal(v) for v in check.values)
        return (f"SELECT count(*) FROM (SELECT {c} AS value_field FROM {m} GROUP BY {c}) t "
                f"WHERE value_field NOT IN ({vals})")
    if check.kind == "relationships":
        return (f"SELECT count(*) FROM {m} child LEFT JOIN {check.to} parent "
                f"ON child.{c} = parent.{check.to_column} "
                f"WHERE child.{c} IS NOT NULL AND parent.{check.to_column} IS NULL")
    if check.kind == "expression":
        return f"SELECT count(*) FROM {m} WHERE NOT ({check.expression})"
    if check.kind == "range":
        conds = []
        if check.min_value is not None:
            conds.append(f"{c} >{'=' if check.inclusive else ''} {check.min_value}")
        if check.max_value is not None:
            conds.append(f"{c} <{'=' if check.inclusive else ''} {check.max_value}")
        return f"SELECT count(*) FROM {m} WHERE NOT ({' AND '.join(conds)})"
    raise ValueError(check.kind)


def checks_sql(checks) -> str:
    """One row per test with outcome and message, as ``run_checks`` returns them."""
    rows = []
    for c in checks:
        column = c.column or ",".join(c.columns) or None
        rows.append(
            f"SELECT {sql_literal(c.name)} AS test_name, {sql_literal(c.kind)} AS test_type, "
            f"{sql_literal(c.model)} AS model_name, "
            f"{sql_literal(column) if column else 'CAST(NULL AS VARCHAR)'} AS column_name, "
            f"{sql_literal(c.severity)} AS severity, CAST(({check_count_sql(c)}) AS BIGINT) AS failures")
    body = "\n UNION ALL ".join(rows)
    return f"""SELECT *,
        CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status,
        CASE WHEN failures = 0 THEN '' ELSE 'Got ' || failures || ' ' || CASE WHEN failures = 1 THEN 'result' ELSE 'results' END || ', configured to '
             || CASE WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END || ' if != 0' END AS message
    FROM ({body}) t"""


# --- planned marts ---------------------------------------------------------------

def gaps_sql(tx: str) -> str:
    return f"""
    SELECT g.transaction_id, g.account_id, g.transaction_at, g.prev_transaction_at,
           (epoch_us(g.transaction_at) - epoch_us(g.prev_transaction_at)) / 1000000.0
               AS seconds_since_prev,
           CASE WHEN g.transaction_at - g.prev_transaction_at < INTERVAL 1 MINUTE THEN 'suspeita_alta'
                WHEN g.transaction_at - g.prev_transaction_at <= INTERVAL 5 MINUTE
                THEN 'suspeita_media' ELSE 'normal' END AS fraud_flag,
           g.transaction_type, g.transaction_amount
    FROM (SELECT t.*, lag(t.transaction_at) OVER (
              PARTITION BY t.account_id ORDER BY t.transaction_at, t.transaction_id,
                                                 t.transaction_amount, t.transaction_type)
              AS prev_transaction_at
          FROM {tx} t) g"""


_mart("transaction_gaps", ("stg_transactions",), gaps_sql("stg_transactions"))
_mart("account_alerts", ("transaction_gaps",), """
    SELECT account_id, count(*) AS transaction_count,
           count(*) FILTER (WHERE fraud_flag = 'suspeita_alta') AS high_alerts,
           count(*) FILTER (WHERE fraud_flag = 'suspeita_media') AS medium_alerts,
           coalesce(sum(transaction_amount) FILTER (WHERE fraud_flag <> 'normal'), 0) AS alert_amount,
           CAST(max(transaction_at) FILTER (WHERE fraud_flag <> 'normal') AS DATE) AS last_alert_date
    FROM transaction_gaps GROUP BY account_id""")


def _statistics(scope: str, kind: str, group: str) -> str:
    x = "CAST(round(transaction_amount * 100) AS HUGEINT)"
    n = "CAST(count(transaction_amount) AS HUGEINT)"
    spread = (f"CAST({n} * sum({x} * {x}) - sum({x}) * sum({x}) AS DOUBLE) "
              f"/ CAST(nullif({n} * ({n} - 1), 0) AS DOUBLE) / 10000")
    return f"""
    SELECT '{scope}' AS scope, {kind} AS transaction_type,
           count(transaction_amount) AS transaction_count,
           {rr(f"sum({x})", f"({n} * 100)", 4)} AS mean_amount,
           round({spread}, 2) AS variance_amount, round(sqrt({spread}), 2) AS stddev_amount,
           min(transaction_amount) AS min_amount, max(transaction_amount) AS max_amount,
           round(quantile_cont(CAST(transaction_amount AS DOUBLE), 0.5), 4) AS median_amount,
           round(quantile_cont(CAST(transaction_amount AS DOUBLE), 0.95), 4) AS p95_amount,
           sqrt({spread}) > 2 * avg(CAST(transaction_amount AS DOUBLE)) AS is_skewed
    FROM stg_transactions {group}"""


_mart("transaction_statistics", ("stg_transactions",),
      _statistics("type", "transaction_type", "GROUP BY transaction_type") + " UNION ALL "
      + _statistics("all", "CAST(NULL AS VARCHAR)", "HAVING count(*) > 0"))

# Each transaction with its own fee, joined row by row.
_mart("priced_transactions", ("stg_transactions", "stg_accounts"), """
    SELECT a.client_id, a.agency_id, t.transaction_type,
           coalesce(f.fixed_fee + f.amount_share * t.transaction_amount, 0) AS fee
    FROM stg_transactions t JOIN stg_accounts a ON a.account_id = t.account_id
    LEFT JOIN (VALUES ('A', CAST(12 AS DECIMAL(10,2)), CAST(0 AS DECIMAL(6,3))),
                      ('N', CAST(0 AS DECIMAL(10,2)), CAST(0 AS DECIMAL(6,3))),
                      ('R', CAST(2.5 AS DECIMAL(10,2)), CAST(0.015 AS DECIMAL(6,3))))
              f(transaction_type, fixed_fee, amount_share)
           ON f.transaction_type = t.transaction_type""")
_FEE5 = "CAST(sum(fee) * 100000 AS HUGEINT)"
_mart("client_fee_revenue", ("priced_transactions",), f"""
    SELECT r.*, m.transaction_type AS most_used_type
    FROM (SELECT client_id AS client_fk, count(*) AS transaction_count, sum(fee) AS fee_revenue,
                 {rr(_FEE5, "count(*) * 100000", 4)} AS mean_fee
          FROM priced_transactions GROUP BY client_id) r
    JOIN (SELECT client_id, transaction_type, row_number() OVER (
              PARTITION BY client_id ORDER BY count(*) DESC, transaction_type) AS place
          FROM priced_transactions GROUP BY client_id, transaction_type) m
      ON m.client_id IS NOT DISTINCT FROM r.client_fk AND m.place = 1""")
_mart("agency_fee_revenue", ("priced_transactions",), f"""
    SELECT agency_id AS agency_fk, sum(fee) AS fee_revenue,
           count(DISTINCT client_id) AS client_count, count(*) AS transaction_count,
           {rr(_FEE5, "count(DISTINCT client_id) * 100000", 2)} AS fee_per_client
    FROM priced_transactions GROUP BY agency_id""")
