"""Registry of runnable queries over the driver's test tables, with their oracle SQL.

Every query reads the driver's Parquet tables of one scale-factor folder
through the crosswalk, builds the models it needs lazily, and returns a
DataFrame with comparable types (see :func:`comparable`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.plans import oracle as O
from ledgerlake.plans.dashboards import DASHBOARDS, dash_volume_anomaly
from ledgerlake.operators.drivers import DEFAULT_DRIVERS, driver_ranking
from ledgerlake.plans.models import EXTENSIONS, MARTS, STAGING, Models
from ledgerlake.operators.quality import (
    Check,
    audit_rows,
    check_pk_duplicates,
    check_pk_not_null,
    check_rank_dense,
    check_row_parity,
    check_single_row,
    check_values_not_null,
    declared_checks,
    run_checks,
)
from ledgerlake.operators.staging import transaction_cast_report
from ledgerlake.schemas import RAW_KEYS
from ledgerlake.session import configure
from ledgerlake.sources.gate import load_counts
from ledgerlake.sources.crosswalk import DriverTables, RawLayer

QueryFn = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Integers as bigint, exact and floating numerics as double; other types unchanged.

    The oracle engine widens integer results differently (e.g. day differences
    and row numbers are 64-bit there) and divides decimals in floating point,
    so both sides agree on these types for the comparison; the models
    themselves keep exact decimals.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType, T.DoubleType)):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(cols)


def models_for(spark: SparkSession, sf_dir: str, tx_source: str = "lineitem") -> Models:
    configure(spark)
    return Models(RawLayer(spark, sf_dir, tx_source))


def _model_query(name: str, tx_source: str = "lineitem") -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(models_for(spark, sf_dir, tx_source)[name])
    run.__name__ = name
    return run


def _dashboard_query(name: str, tx_source: str = "lineitem", **params) -> QueryFn:
    builder, mart = DASHBOARDS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(builder(models_for(spark, sf_dir, tx_source)[mart], **params))
    run.__name__ = name
    return run


# --- oracle bodies --------------------------------------------------------

def _d(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


def _b(c: str) -> str:
    return f"CAST({c} AS BIGINT)"


def _q(c: str) -> str:
    return '"' + c.replace('"', '""') + '"'


# Output columns of each model, with how the oracle normalizes them:
# "d" double, "b" bigint, "" unchanged.
MODEL_COLUMNS: dict[str, list[tuple[str, str]]] = {
    "stg_agencies": [("agency_id", "b"), ("agency_name", ""), ("address", ""), ("city", ""),
                     ("state", ""), ("opening_date", ""), ("agency_type", "")],
    "stg_clients": [("client_id", "b"), ("client_full_name", ""), ("email", ""),
                    ("client_type", ""), ("onboarding_date", ""), ("cpf_cnpj", ""),
                    ("birth_date", ""), ("address", ""), ("postal_code", "")],
    "stg_employees": [("employee_id", "b"), ("first_name", ""), ("last_name", ""), ("email", ""),
                      ("cpf", ""), ("birth_date", ""), ("address", ""), ("postal_code", "")],
    "stg_employee_agency": [("employee_id", "b"), ("agency_id", "b")],
    "stg_accounts": [("account_id", "b"), ("client_id", "b"), ("agency_id", "b"),
                     ("employee_id", "b"), ("account_type", ""), ("opening_date", ""),
                     ("total_balance", "d"), ("available_balance", "d"),
                     ("last_posting_date", "")],
    "stg_proposals": [("proposal_id", "b"), ("client_id", "b"), ("employee_id", "b"),
                      ("proposal_date", ""), ("monthly_interest_rate", "d"),
                      ("proposal_amount", "d"), ("financing_amount", "d"), ("down_payment", "d"),
                      ("installment_amount", "d"), ("installment_count", "b"),
                      ("grace_period", "b"), ("proposal_status", "")],
    "stg_transactions": [("transaction_id", "b"), ("account_id", "b"), ("transaction_at", ""),
                         ("transaction_type", ""), ("transaction_amount", "d")],
    "account_activity": [("account_sk", "b"), ("client_fk", "b"), ("agency_fk", "b"),
                         ("total_balance", "d"), ("last_transaction_date", ""),
                         ("days_since_last_transaction", "b"), ("activity_status", "")],
    "credit_funnel": [("month", ""), ("proposal_status", ""), ("proposal_count", "b"),
                      ("total_proposal_amount", "d"), ("avg_interest_rate", "d")],
    "agency_performance": [("agency_sk", "b"), ("agency_name", ""), ("agency_type", ""),
                           ("total_proposals", "b"), ("approved_proposals", "b"),
                           ("conversion_rate_pct", "d"), ("total_proposal_amount", "d")],
    "daily_volume": [("transaction_date", ""), ("transaction_type", ""),
                     ("transaction_count", "b"), ("distinct_accounts", "b"),
                     ("avg_tx_per_account", "d")],
    "client_engagement": [("client_sk", "b"), ("client_full_name", ""), ("client_type", ""),
                          ("onboarding_date", ""), ("account_count", "b"), ("total_balance", "d"),
                          ("transaction_count", "b"), ("transaction_total_amount", "d"),
                          ("avg_tx_per_account", "d"), ("last_transaction_date", ""),
                          ("days_since_last_transaction", "b"), ("relationship_days", "b"),
                          ("has_approved_credit", ""), ("engagement_status", "")],
    "commercial_kpis": [("total_clientes", "b"), ("clientes_ativos", "b"),
                        ("clientes_em_risco", "b"), ("clientes_churned", "b"),
                        ("clientes_sem_uso", "b"), ("taxa_ativos_pct", "d"),
                        ("taxa_inativos_pct", "d"), ("media_transacoes_por_cliente", "d"),
                        ("taxa_posse_credito_pct", "d")],
    "credit_kpis": [("total_proposals", "b"), ("approved_proposals", "b"),
                    ("rejected_proposals", "b"), ("approval_rate_pct", "d"),
                    ("total_proposal_amount", "d"), ("total_financed_amount", "d"),
                    ("avg_interest_rate_pct", "d")],
    "cross_sell": [("client_fk", "b"), ("client_full_name", ""), ("account_fk", "b"),
                   ("total_balance", "d"), ("agency_fk", "b")],
    "quality_dashboard": [("model_name", ""), ("column_name", ""), ("test_type", ""),
                          ("status", ""), ("failure_count", "b"), ("message", "")],
    "driver_ranking": [("driver", ""), ("correlation", "d"), ("abs_correlation", "d"),
                       ("r_squared_pct", "d"), ("direction", ""), ("sample_size", "b"),
                       ("t_statistic", "d"), ("significant_at_5pct", ""), ("impact_rank", "b")],
    "transaction_gaps": [("transaction_id", "b"), ("account_id", "b"), ("transaction_at", ""),
                         ("prev_transaction_at", ""), ("seconds_since_prev", "d"),
                         ("fraud_flag", ""), ("transaction_type", ""),
                         ("transaction_amount", "d")],
    "account_alerts": [("account_id", "b"), ("transaction_count", "b"), ("high_alerts", "b"),
                       ("medium_alerts", "b"), ("alert_amount", "d"), ("last_alert_date", "")],
    "transaction_statistics": [("scope", ""), ("transaction_type", ""),
                               ("transaction_count", "b"), ("mean_amount", "d"),
                               ("variance_amount", "d"), ("stddev_amount", "d"),
                               ("min_amount", "d"), ("max_amount", "d"), ("median_amount", "d"),
                               ("p95_amount", "d"), ("is_skewed", "")],
    "client_fee_revenue": [("client_fk", "b"), ("transaction_count", "b"), ("fee_revenue", "d"),
                           ("mean_fee", "d"), ("most_used_type", "")],
    "agency_fee_revenue": [("agency_fk", "b"), ("fee_revenue", "d"), ("client_count", "b"),
                           ("transaction_count", "b"), ("fee_per_client", "d")],
}


def select_normalized(columns: list[tuple[str, str]], source: str) -> str:
    exprs = []
    for name, kind in columns:
        q = _q(name)
        expr = _d(q) if kind == "d" else _b(q) if kind == "b" else q
        exprs.append(f"{expr} AS {q}")
    return f"SELECT {', '.join(exprs)} FROM {source}"


def model_oracle(name: str, tx_source: str = "lineitem") -> str:
    rename = {"stg_transactions": "stg_transactions_events"} if tx_source == "events" else None
    return O.with_ctes(select_normalized(MODEL_COLUMNS[name], name), name, rename=rename)


# SQL of each dashboard over its mart (before normalization), and its output types.
DASHBOARD_SQL: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "dash_kpi_cards": ("""SELECT total_clientes, clientes_ativos, taxa_ativos_pct, taxa_inativos_pct,
        media_transacoes_por_cliente FROM commercial_kpis""",
        [("total_clientes", "b"), ("clientes_ativos", "b"), ("taxa_ativos_pct", "d"),
         ("taxa_inativos_pct", "d"), ("media_transacoes_por_cliente", "d")]),
    "dash_status_distribution": ("""SELECT engagement_status, count(*) AS clientes
        FROM client_engagement GROUP BY engagement_status""",
        [("engagement_status", ""), ("clientes", "b")]),
    "dash_top20_at_risk": ("""SELECT client_sk, client_full_name, total_balance, transaction_count,
        days_since_last_transaction FROM client_engagement WHERE engagement_status = 'at_risk'
        ORDER BY total_balance DESC NULLS FIRST, client_sk LIMIT 20""",
        [("client_sk", "b"), ("client_full_name", ""), ("total_balance", "d"),
         ("transaction_count", "b"), ("days_since_last_transaction", "b")]),
    "dash_driver_ranking": ("""SELECT impact_rank, driver, correlation, direction, significant_at_5pct
        FROM driver_ranking""",
        [("impact_rank", "b"), ("driver", ""), ("correlation", "d"), ("direction", ""),
         ("significant_at_5pct", "")]),
    "dash_total_proposals": ("SELECT count(*) AS total_proposals FROM stg_proposals",
                             [("total_proposals", "b")]),
    # these four cards are counted from the proposals themselves, not from the funnel mart
    "dash_approval_rate": (f"""SELECT {O.rr("count(*) FILTER (WHERE proposal_status = 'Aprovada')",
        'count(*)', 2, 100)} AS approval_rate_pct FROM stg_proposals""",
        [("approval_rate_pct", "d")]),
    "dash_financed_amount": ("""SELECT coalesce(sum(proposal_amount)
        FILTER (WHERE proposal_status = 'Aprovada'), 0) AS total_financed_amount
        FROM stg_proposals""", [("total_financed_amount", "d")]),
    "dash_funnel_monthly": ("SELECT month, proposal_status, proposal_count FROM credit_funnel",
                            [("month", ""), ("proposal_status", ""), ("proposal_count", "b")]),
    "dash_funnel_by_status": ("""SELECT proposal_status, count(*) AS total,
        sum(proposal_amount) AS total_amount FROM stg_proposals GROUP BY ALL""",
        [("proposal_status", ""), ("total", "b"), ("total_amount", "d")]),
    "dash_agency_conversion": ("""SELECT agency_name, agency_type, total_proposals, approved_proposals,
        conversion_rate_pct, round(total_proposal_amount, 2) AS total_proposal_amount
        FROM agency_performance""",
        [("agency_name", ""), ("agency_type", ""), ("total_proposals", "b"),
         ("approved_proposals", "b"), ("conversion_rate_pct", "d"),
         ("total_proposal_amount", "d")]),
    "dash_funnel_detail": ("""SELECT month, proposal_status, proposal_count,
        round(total_proposal_amount, 2) AS total_proposal_amount,
        round(avg_interest_rate * 100, 4) AS avg_interest_rate_pct FROM credit_funnel""",
        [("month", ""), ("proposal_status", ""), ("proposal_count", "b"),
         ("total_proposal_amount", "d"), ("avg_interest_rate_pct", "d")]),
    "dash_stuck_sent": ("""SELECT month, proposal_status, proposal_count, total_proposal_amount
        FROM credit_funnel WHERE proposal_status = 'Enviada'""",
        [("month", ""), ("proposal_status", ""), ("proposal_count", "b"),
         ("total_proposal_amount", "d")]),
    "dash_agency_ranking": ("""SELECT agency_sk, agency_name, agency_type, total_proposals,
        approved_proposals, conversion_rate_pct, total_proposal_amount FROM agency_performance""",
        [("agency_sk", "b"), ("agency_name", ""), ("agency_type", ""), ("total_proposals", "b"),
         ("approved_proposals", "b"), ("conversion_rate_pct", "d"),
         ("total_proposal_amount", "d")]),
    "dash_idle_accounts": ("""SELECT account_sk, client_fk, agency_fk, total_balance,
        last_transaction_date, days_since_last_transaction, activity_status
        FROM account_activity WHERE activity_status IN ('dormant', 'never_used')""",
        MODEL_COLUMNS["account_activity"]),
    "dash_cross_sell": ("""SELECT client_fk, client_full_name, account_fk, total_balance, agency_fk
        FROM cross_sell""", MODEL_COLUMNS["cross_sell"]),
}

# the label of the highest bound that a significant driver's explained variance reaches
_VERDICT = """coalesce((SELECT arg_max(label, low)
        FROM (VALUES (-1, 'Significativo mas fraco'), (5, 'Relevante')) b(low, label)
        WHERE significant_at_5pct AND low <= r_squared_pct), 'Sem evidência')"""
DASHBOARD_SQL["dash_driver_verdict"] = (
    f"""SELECT impact_rank, driver, correlation, direction, significant_at_5pct, r_squared_pct,
        sample_size, {_VERDICT} AS verdict FROM driver_ranking""",
    [("impact_rank", "b"), ("driver", ""), ("correlation", "d"), ("direction", ""),
     ("significant_at_5pct", ""), ("r_squared_pct", "d"), ("sample_size", "b"), ("verdict", "")])
DASHBOARD_SQL["dash_driver_table"] = (
    f"""SELECT impact_rank AS "#", driver AS "Alavanca", correlation AS "r (Pearson)",
        CAST(r_squared_pct AS VARCHAR) || '%' AS "r² (variância explicada)",
        CASE WHEN significant_at_5pct THEN 'Sim' ELSE 'Não' END AS "Significativo (p<0,05)?",
        {_VERDICT} AS "Veredito", sample_size AS "n (clientes)" FROM driver_ranking""",
    [("#", "b"), ("Alavanca", ""), ("r (Pearson)", "d"), ("r² (variância explicada)", ""),
     ("Significativo (p<0,05)?", ""), ("Veredito", ""), ("n (clientes)", "b")])


def anomaly_sql(year: int, month: int, sigmas: float) -> tuple[str, list[tuple[str, str]]]:
    body = f"""SELECT v.transaction_date, v.transaction_type, v.transaction_count,
               v.distinct_accounts, v.avg_tx_per_account,
               CASE WHEN v.transaction_count > lim.cutoff THEN 'ANOMALY' ELSE 'NORMAL' END AS flag
        FROM daily_volume v,
             (SELECT avg(transaction_count) + {sigmas} * stddev_samp(transaction_count) AS cutoff
              FROM daily_volume) lim
        WHERE date_trunc('month', v.transaction_date) = DATE '{year:04d}-{month:02d}-01'"""
    return body, MODEL_COLUMNS["daily_volume"] + [("flag", "")]


def dashboard_oracle(name: str, tx_source: str = "lineitem", **params) -> str:
    if name == "dash_volume_anomaly":
        sql, cols = anomaly_sql(params.get("year", 2022), params.get("month", 12),
                                params.get("sigmas", 3))
    else:
        sql, cols = DASHBOARD_SQL[name]
    mart = DASHBOARDS[name][1]
    rename = {"stg_transactions": "stg_transactions_events"} if tx_source == "events" else None
    return O.with_ctes(select_normalized(cols, f"(\n{sql}\n) q"), mart, rename=rename)


# --- the registry ---------------------------------------------------------

def _anomaly_query(tx_source: str, **params) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(dash_volume_anomaly(
            models_for(spark, sf_dir, tx_source)["daily_volume"], **params))
    return run


CHECK_COLUMNS = [("test_name", ""), ("test_type", ""), ("model_name", ""), ("column_name", ""),
                 ("severity", ""), ("failures", "b"), ("status", ""), ("message", "")]


def _data_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared test suite (catalog tests excluded: they need written tables).

    All tests of a model share one scan of it (see ``run_checks``), so each
    model is evaluated about once per suite, straight from the sources.
    """
    checks = declared_checks(include_catalog=False)
    return comparable(run_checks(checks, models_for(spark, sf_dir)))


def _data_tests_sql() -> str:
    checks = declared_checks(include_catalog=False)
    models = sorted({c.model for c in checks} | {c.to for c in checks if c.to})
    return O.with_ctes(select_normalized(CHECK_COLUMNS, f"({O.checks_sql(checks)}) q"), *models)


# Orphan documents: the relationship test on a pair of tables that has orphans.
ORPHAN_DOCUMENTS = Check("relationships", "documents", "doc_id", to="labels",
                         to_column="doc_id", severity="warn")


def _orphan_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    driver = DriverTables(spark, sf_dir)
    tables = {t: driver.table(t) for t in ("documents", "labels")}
    return comparable(run_checks([ORPHAN_DOCUMENTS], tables))


def _raw_load_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(load_counts(RawLayer(spark, sf_dir).as_dict()))


def _raw_load_gate_sql() -> str:
    raw_of = {"stg_agencies": "agencias", "stg_clients": "clientes", "stg_employees": "colaboradores",
              "stg_employee_agency": "colaborador_agencia", "stg_accounts": "contas",
              "stg_proposals": "propostas_credito", "stg_transactions": "transacoes"}
    body = " UNION ALL ".join(f"SELECT '{raw}' AS table_name, count(*) AS row_count FROM {stg}"
                              for stg, raw in raw_of.items())
    return O.with_ctes(select_normalized([("table_name", ""), ("row_count", "b")], f"({body}) q"),
                       *raw_of)


def _pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = RawLayer(spark, sf_dir)
    keys = {t: RAW_KEYS[t] for t in RAW_KEYS}
    return comparable(check_pk_duplicates({t: raw[t] for t in keys}, keys))


def _pk_duplicates_sql() -> str:
    parts = []
    for stg, raw, key in (("stg_agencies", "agencias", "agency_id"),
                          ("stg_clients", "clientes", "client_id"),
                          ("stg_employees", "colaboradores", "employee_id"),
                          ("stg_accounts", "contas", "account_id"),
                          ("stg_proposals", "propostas_credito", "proposal_id"),
                          ("stg_transactions", "transacoes", "transaction_id")):
        parts.append(f"SELECT '{raw}' AS table_name, count(*) - count(DISTINCT {key}) AS duplicate_keys "
                     f"FROM {stg}")
    parts.append("SELECT 'colaborador_agencia' AS table_name, count(*) - (SELECT count(*) FROM "
                 "(SELECT DISTINCT employee_id, agency_id FROM stg_employee_agency "
                 "WHERE employee_id IS NOT NULL AND agency_id IS NOT NULL) d) AS duplicate_keys "
                 "FROM stg_employee_agency")
    body = " UNION ALL ".join(parts)
    return O.with_ctes(select_normalized([("table_name", ""), ("duplicate_keys", "b")], f"({body}) q"),
                       "stg_agencies", "stg_clients", "stg_employees", "stg_employee_agency",
                       "stg_accounts", "stg_proposals", "stg_transactions")


def _pk_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = RawLayer(spark, sf_dir)
    return comparable(check_pk_not_null({t: raw[t] for t in RAW_KEYS}, RAW_KEYS))


def _pk_not_null_sql() -> str:
    keys = {"stg_agencies": ("agencias", ["agency_id"]), "stg_clients": ("clientes", ["client_id"]),
            "stg_employees": ("colaboradores", ["employee_id"]),
            "stg_employee_agency": ("colaborador_agencia", ["employee_id", "agency_id"]),
            "stg_accounts": ("contas", ["account_id"]),
            "stg_proposals": ("propostas_credito", ["proposal_id"]),
            "stg_transactions": ("transacoes", ["transaction_id"])}
    body = " UNION ALL ".join(
        f"SELECT '{raw}' AS table_name, count_if({' OR '.join(f'{k} IS NULL' for k in cols)}) "
        f"AS null_keys FROM {stg}" for stg, (raw, cols) in keys.items())
    return O.with_ctes(select_normalized([("table_name", ""), ("null_keys", "b")], f"({body}) q"),
                       *keys)


def _rank_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(check_rank_dense(models_for(spark, sf_dir)["driver_ranking"], "impact_rank"))


def _rank_dense_sql() -> str:
    body = """SELECT min(impact_rank) AS min_rank, max(impact_rank) AS max_rank, count(*) AS total,
        count(DISTINCT impact_rank) AS distinct_ranks,
        coalesce(min(impact_rank) = 1 AND max(impact_rank) = count(*)
                 AND count(DISTINCT impact_rank) = count(*), count(*) = 0) AS is_dense
        FROM driver_ranking"""
    cols = [("min_rank", "b"), ("max_rank", "b"), ("total", "b"), ("distinct_ranks", "b"),
            ("is_dense", "")]
    return O.with_ctes(select_normalized(cols, f"({body}) q"), "driver_ranking")


def _single_row(mart: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(check_single_row(models_for(spark, sf_dir)[mart]))
    return run


def _single_row_sql(mart: str) -> str:
    body = f"SELECT count(*) AS row_count, count(*) = 1 AS is_single_row FROM {mart}"
    return O.with_ctes(select_normalized([("row_count", "b"), ("is_single_row", "")],
                                         f"({body}) q"), mart)


def _cast_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(transaction_cast_report(RawLayer(spark, sf_dir)["transacoes"]))


def _cast_report_sql() -> str:
    body = """SELECT
        count(*) FILTER (WHERE l_orderkey IS NOT NULL AND try_cast(l_orderkey * 10 + l_linenumber AS BIGINT) IS NULL) AS bad_transaction_id,
        count(*) FILTER (WHERE l_orderkey IS NOT NULL AND try_cast(l_orderkey AS BIGINT) IS NULL) AS bad_account_id,
        count(*) FILTER (WHERE l_shipdate IS NOT NULL AND try_cast(l_shipdate AS TIMESTAMP) IS NULL) AS bad_transaction_at,
        count(*) FILTER (WHERE l_extendedprice IS NOT NULL AND try_cast(l_extendedprice AS DECIMAL(18,2)) IS NULL) AS bad_transaction_amount,
        count(*) FILTER (WHERE CAST(l_extendedprice AS DECIMAL(38,10)) <> CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(38,10))) AS scale_loss_transaction_amount,
        count(*) AS total_rows
        FROM lineitem"""
    cols = [("bad_transaction_id", "b"), ("bad_account_id", "b"), ("bad_transaction_at", "b"),
            ("bad_transaction_amount", "b"), ("scale_loss_transaction_amount", "b"), ("total_rows", "b")]
    return select_normalized(cols, f"({body}) q")


def _row_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L-01: every row of the driver's tables reaches its raw table."""
    raw, driver = RawLayer(spark, sf_dir), DriverTables(spark, sf_dir)
    return comparable(check_row_parity({t: driver.table(s) for t, s in SOURCE_OF.items()},
                                       {t: raw[t] for t in SOURCE_OF}))


def _row_parity_sql() -> str:
    of = {"agencias": "stg_agencies", "clientes": "stg_clients", "colaboradores": "stg_employees",
          "colaborador_agencia": "stg_employee_agency", "contas": "stg_accounts",
          "propostas_credito": "stg_proposals", "transacoes": "stg_transactions"}
    rows = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {SOURCE_OF[t]}) AS source_rows, "
        f"(SELECT count(*) FROM {stg}) AS raw_rows" for t, stg in of.items())
    body = f"SELECT *, if(source_rows = raw_rows, 'pass', 'fail') AS status FROM ({rows}) c"
    return O.with_ctes(select_normalized(
        [("table_name", ""), ("source_rows", "b"), ("raw_rows", "b"), ("status", "")],
        f"({body}) q"), *of.values())


#: Raw table -> the driver's table that its rows come from.
SOURCE_OF = {"agencias": "nation", "clientes": "customer", "colaboradores": "supplier",
             "colaborador_agencia": "supplier", "contas": "orders",
             "propostas_credito": "lineitem", "transacoes": "lineitem"}
#: L-06: columns whose values must be there (the last one is NULL in the driver's data).
FILLED = {"transacoes": ["valor_transacao", "data_transacao"], "contas": ["saldo_total"],
          "propostas_credito": ["valor_proposta", "valor_financiamento"]}


def _values_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = RawLayer(spark, sf_dir)
    return comparable(check_values_not_null({t: raw[t] for t in FILLED}, FILLED))


def _values_not_null_sql() -> str:
    stg = {("transacoes", "valor_transacao"): "stg_transactions.transaction_amount",
           ("transacoes", "data_transacao"): "stg_transactions.transaction_at",
           ("contas", "saldo_total"): "stg_accounts.total_balance",
           ("propostas_credito", "valor_proposta"): "stg_proposals.proposal_amount",
           ("propostas_credito", "valor_financiamento"): "stg_proposals.financing_amount"}
    rows = []
    for (t, c), place in stg.items():
        table, column = place.split(".")
        rows.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
                    f"count(*) - count({column}) AS null_values FROM {table}")
    body = (f"SELECT *, if(null_values = 0, 'pass', 'fail') AS status "
            f"FROM ({' UNION ALL '.join(rows)}) c")
    return O.with_ctes(select_normalized(
        [("table_name", ""), ("column_name", ""), ("null_values", "b"), ("status", "")],
        f"({body}) q"), "stg_transactions", "stg_accounts", "stg_proposals")


def _transactions_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-07 over a text landing: every column arrives as text and is parsed by staging."""
    landed = RawLayer(spark, sf_dir)["transacoes"]
    text = landed.select([F.col(c).cast("string").alias(c) for c in landed.columns])
    return comparable(STAGING["stg_transactions"][1](text))


def _test_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-06: the audit rows of the declared suite, without their time stamp."""
    checks = declared_checks(include_catalog=False)
    return comparable(audit_rows(run_checks(checks, models_for(spark, sf_dir))).drop("executed_at"))


def _test_results_sql() -> str:
    checks = declared_checks(include_catalog=False)
    models = sorted({c.model for c in checks} | {c.to for c in checks if c.to})
    body = (f"SELECT test_name, model_name, coalesce(column_name, 'N/A') AS column_name, status, "
            f"message FROM ({O.checks_sql(checks)}) r")
    return O.with_ctes(body, *models)


# A driver that is constant on every engagement row (each row owns an account):
# its correlation is undefined, so it must be dropped from the ranking.
CONSTANT_DRIVER = ("possui_conta", "has_account")


def _ranking_with_constant_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    engagement = models_for(spark, sf_dir)["client_engagement"]
    with_flag = engagement.withColumn("has_account", F.col("account_count") >= F.lit(1))
    return comparable(driver_ranking(with_flag, drivers=DEFAULT_DRIVERS + (CONSTANT_DRIVER,)))


def _ranking_with_constant_driver_sql() -> str:
    drivers = O._DRIVERS + ((CONSTANT_DRIVER[0], "CASE WHEN account_count >= 1 THEN 1.0 ELSE 0.0 END"),)
    sql = O.with_ctes(select_normalized(MODEL_COLUMNS["driver_ranking"], "ranking"),
                      "client_engagement")
    return O.with_extra_cte(sql, "ranking", O.driver_ranking_sql(drivers))


def build_registry() -> tuple[dict[str, QueryFn], dict[str, str]]:
    queries: dict[str, QueryFn] = {}
    sql: dict[str, str] = {}
    for name in list(STAGING) + list(MARTS):
        queries[name] = _model_query(name)
        sql[name] = model_oracle(name)
    for name in EXTENSIONS:
        queries[name] = _model_query(name)
        sql[name] = model_oracle(name)
    for name in ("transaction_gaps", "account_alerts", "transaction_statistics"):
        queries[f"{name}_events"] = _model_query(name, "events")
        sql[f"{name}_events"] = model_oracle(name, "events")
    # The events table spans one month with several events per user and day,
    # so the daily-volume views also run on it.
    queries["daily_volume_events"] = _model_query("daily_volume", "events")
    sql["daily_volume_events"] = model_oracle("daily_volume", "events")
    for name in DASHBOARDS:
        if name == "dash_volume_anomaly":
            continue
        queries[name] = _dashboard_query(name)
        sql[name] = dashboard_oracle(name)
    # Anomaly card: the reference month has no data in the test tables, so the
    # card also runs on the events month, with the reference's 3 sigma and 2.
    queries["dash_volume_anomaly"] = _anomaly_query("lineitem")
    sql["dash_volume_anomaly"] = dashboard_oracle("dash_volume_anomaly")
    for sigmas in (3, 2):
        key = f"dash_volume_anomaly_events_k{sigmas}"
        queries[key] = _anomaly_query("events", year=2024, month=1, sigmas=sigmas)
        sql[key] = dashboard_oracle("dash_volume_anomaly", "events", year=2024, month=1,
                                    sigmas=sigmas)
    queries["data_tests"] = _data_tests
    sql["data_tests"] = _data_tests_sql()
    queries["orphan_documents_labels"] = _orphan_documents
    sql["orphan_documents_labels"] = select_normalized(
        CHECK_COLUMNS, f"({O.checks_sql([ORPHAN_DOCUMENTS])}) q")
    queries["raw_load_gate"] = _raw_load_gate
    sql["raw_load_gate"] = _raw_load_gate_sql()
    queries["pk_duplicates_raw"] = _pk_duplicates
    sql["pk_duplicates_raw"] = _pk_duplicates_sql()
    queries["pk_not_null_raw"] = _pk_not_null
    sql["pk_not_null_raw"] = _pk_not_null_sql()
    queries["rank_dense_driver_ranking"] = _rank_dense
    sql["rank_dense_driver_ranking"] = _rank_dense_sql()
    for mart in ("commercial_kpis", "credit_kpis"):
        queries[f"single_row_{mart}"] = _single_row(mart)
        sql[f"single_row_{mart}"] = _single_row_sql(mart)
    queries["driver_ranking_with_constant_driver"] = _ranking_with_constant_driver
    sql["driver_ranking_with_constant_driver"] = _ranking_with_constant_driver_sql()
    queries["row_parity_raw"] = _row_parity
    sql["row_parity_raw"] = _row_parity_sql()
    queries["values_not_null_raw"] = _values_not_null
    sql["values_not_null_raw"] = _values_not_null_sql()
    queries["stg_transactions_text"] = _transactions_from_text
    sql["stg_transactions_text"] = model_oracle("stg_transactions")
    queries["test_results"] = _test_results
    sql["test_results"] = _test_results_sql()
    queries["transaction_cast_report"] = _cast_report
    sql["transaction_cast_report"] = _cast_report_sql()
    return queries, sql
