"""Data-quality checks: generic column tests, the live quality dashboard, load checks.

Generic tests (V-01 … V-07) follow the usual data-test semantics: a test
selects its failing records, a non-zero count fails the test (or warns when
its severity is ``warn``), and NULLs pass every test except ``not_null``.

Execution plan: :func:`run_checks` does not run one query per test. A model's
row-level tests are one global aggregate, its key tests one grouping-sets
aggregate over the key columns; relationship tests count the child per key
before an anti join. The per-test counts are unioned into one small DataFrame
whose result has one row per test.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.activity import ACTIVITY_STATUSES
from ledgerlake.operators.credit import PROPOSAL_STATUSES
from ledgerlake.operators.drivers import DIRECTIONS
from ledgerlake.operators.engagement import ENGAGEMENT_STATUSES

# Outcome labels of the generic tests and of the live dashboard,
# and the live dashboard's message texts.
PASS, FAIL, WARN = "pass", "fail", "warn"
DASH_PASS, DASH_FAIL = "PASS", "FAIL"
ORPHAN_MESSAGE = "Found %d %s(s) referencing non-existent client(s)"
NULL_MESSAGE = "null check on %s"
UNIQUE_MESSAGE = "uniqueness check on %s"

ROW_LEVEL = ("not_null", "accepted_values", "expression", "range")


@dataclass(frozen=True)
class Check:
    """One declared test.

    kind: unique | not_null | relationships | accepted_values |
          unique_combination | expression | range
    """

    kind: str
    model: str
    column: str | None = None
    columns: tuple[str, ...] = ()
    values: tuple = ()
    expression: str | None = None
    to: str | None = None
    to_column: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    inclusive: bool = True
    severity: str = "error"

    @property
    def name(self) -> str:
        target = self.column or "_".join(self.columns) or "row"
        suffix = f"__{self.to}_{self.to_column}" if self.kind == "relationships" else ""
        return f"{self.kind}_{self.model}_{target}{suffix}"


# --- failing-row conditions (row-level tests) --------------------------------

def failing_condition(check: Check) -> Column:
    """Row predicate that is true exactly on failing rows (NULL counts as not failing)."""
    if check.kind == "not_null":
        return F.col(check.column).isNull()
    if check.kind == "accepted_values":
        return ~F.col(check.column).isin(*check.values)
    if check.kind == "expression":
        return ~F.expr(check.expression)
    if check.kind == "range":
        c = F.col(check.column)
        ok = F.lit(True)
        if check.min_value is not None:
            ok = ok & ((c >= check.min_value) if check.inclusive else (c > check.min_value))
        if check.max_value is not None:
            ok = ok & ((c <= check.max_value) if check.inclusive else (c < check.max_value))
        return ~ok
    raise ValueError(f"{check.kind} is not a row-level test")


def failing_rows(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The records a test selects (for inspection of a failure)."""
    df = tables[check.model]
    if check.kind in ROW_LEVEL:
        if check.kind == "accepted_values":
            return (df.where(F.coalesce(failing_condition(check), F.lit(False)))
                    .groupBy(F.col(check.column).alias("value_field"))
                    .agg(F.count(F.lit(1)).alias("n_records")))
        return df.where(F.coalesce(failing_condition(check), F.lit(False)))
    if check.kind == "unique":
        return (df.where(F.col(check.column).isNotNull())
                .groupBy(check.column).agg(F.count(F.lit(1)).alias("n_records"))
                .where(F.col("n_records") > 1))
    if check.kind == "unique_combination":
        return (df.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("n_records"))
                .where(F.col("n_records") > 1))
    if check.kind == "relationships":
        parent = tables[check.to].select(F.col(check.to_column).alias("_parent_key"))
        child = df.where(F.col(check.column).isNotNull())
        return child.join(parent, child[check.column] == parent["_parent_key"], "left_anti")
    raise ValueError(f"unknown test kind {check.kind!r}")


# --- counting -----------------------------------------------------------------

def _grouping(check: Check) -> tuple[str, ...]:
    """Grouping set a test needs: () for row-level tests, its key columns otherwise."""
    if check.kind in ("unique", "accepted_values"):
        return (check.column,)
    if check.kind == "unique_combination":
        return tuple(check.columns)
    return ()


def _model_counts(df: DataFrame, checks: Sequence[tuple[int, Check]]) -> list[DataFrame]:
    """Every non-relationship test of one model, as result rows.

    Row-level tests (not_null, expression, range) are one global aggregate:
    every task sends a single row. Key tests (unique, accepted_values,
    unique_combination) share a second pass that reads key columns only: one
    grouping set per key, partial counts before the single shuffle (a key that
    holds a third of the rows is one row per task), then failures per set.
    """
    row_level = [(idx, c) for idx, c in checks if not _grouping(c)]
    keyed = [(idx, c) for idx, c in checks if _grouping(c)]
    parts = []
    if row_level:
        wide = df.agg(*[F.count_if(failing_condition(c)).cast("long").alias(f"__f{idx}")
                        for idx, c in row_level])
        parts.append(_result_rows(wide, row_level))
    if keyed:
        sets = list(dict.fromkeys(_grouping(c) for _, c in keyed))
        keys = list(dict.fromkeys(k for g in sets for k in g))
        grouped = df.groupingSets([list(g) for g in sets], *keys).agg(
            F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__gid"))
        finals = []
        for idx, c in keyed:
            own = _grouping(c)
            number = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in own)
            fails = F.col("__gid") == F.lit(number)
            if c.kind == "accepted_values":
                # one failing record per distinct value outside the list (NULL passes)
                fails = fails & ~F.col(c.column).isin(*c.values)
            else:
                fails = fails & (F.col("__n") > 1)
            if c.kind != "unique_combination":
                fails = fails & F.col(c.column).isNotNull()
            finals.append(F.count_if(fails).cast("long").alias(f"__f{idx}"))
        parts.append(_result_rows(grouped.agg(*finals), keyed))
    return parts


def _result_rows(wide: DataFrame, checks: Sequence[tuple[int, Check]]) -> DataFrame:
    """One row per test from one row of counts."""
    rows = ", ".join(_meta_struct(c, f"__f{idx}") for idx, c in checks)
    return wide.selectExpr(f"inline(array({rows}))")


def _sql_str(value: str | None) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _meta_struct(check: Check, failures: str) -> str:
    """SQL ``named_struct`` of one test's result row: its literal description and count."""
    column = check.column or ",".join(check.columns) or None
    return (f"named_struct('test_name', {_sql_str(check.name)}, "
            f"'test_type', {_sql_str(check.kind)}, 'model_name', {_sql_str(check.model)}, "
            f"'column_name', {_sql_str(column)}, 'severity', {_sql_str(check.severity)}, "
            f"'failures', CAST({failures} AS BIGINT))")


def orphan_total(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """``__n``: rows of ``child`` whose ``key`` (NULL included) isn't a ``parent_key``.

    The child is counted per key before the anti join, so a key or NULL that
    holds a third of the rows crosses the shuffle as one row per task.
    """
    per_key = child.groupBy(F.col(key).alias("_child_key")).agg(F.count(F.lit(1)).alias("_rows"))
    known = parent.select(F.col(parent_key).alias("_parent_key"))
    missing = per_key.join(known, F.col("_child_key") == F.col("_parent_key"), "left_anti")
    return missing.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("__n"))


def _orphan_count(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    child = tables[check.model].where(F.col(check.column).isNotNull())
    counted = orphan_total(child, check.column, tables[check.to], check.to_column)
    return counted.selectExpr(f"inline(array({_meta_struct(check, '__n')}))")


def check_counts(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per test: ``(test_name, test_type, model_name, column_name, severity, failures)``."""
    parts: list[DataFrame] = []
    meta = list(enumerate(checks))
    by_model: dict[str, list[tuple[int, Check]]] = {}
    for idx, check in meta:
        if check.kind != "relationships":
            by_model.setdefault(check.model, []).append((idx, check))
    for model, sub in by_model.items():
        parts += _model_counts(tables[model], sub)
    for idx, check in meta:
        if check.kind == "relationships":
            parts.append(_orphan_count(check, tables))
    return reduce(DataFrame.union, parts)  # every part has the same columns in the same order


def with_status(counts: DataFrame) -> DataFrame:
    """Add the outcome: ``pass`` at zero failures, else ``warn`` for warn-severity, else ``fail``."""
    status = (F.when(F.col("failures") == 0, F.lit(PASS))
              .when(F.col("severity") == F.lit("warn"), F.lit(WARN))
              .otherwise(F.lit(FAIL)))
    return counts.withColumn("status", status)


def run_checks(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Counts and outcome of every test, with a message (one row per test)."""
    result = with_status(check_counts(checks, tables))
    message = F.when(F.col("failures") == 0, F.lit("")).otherwise(
        F.concat(F.lit("Got "), F.col("failures").cast("string"),
                 F.when(F.col("failures") == 1, F.lit(" result")).otherwise(F.lit(" results")),
                 F.lit(", configured to "),
                 F.when(F.col("severity") == F.lit("warn"), F.lit("warn")).otherwise(F.lit("fail")),
                 F.lit(" if != 0")))
    return result.withColumn("message", message)


def audit_rows(results: DataFrame, stamp: Column | None = None) -> DataFrame:
    """K-06: results shaped as the ``test_results`` audit table, stamped with the load time
    (``stamp``, or now)."""
    return results.select(
        "test_name", "model_name",
        F.coalesce(F.col("column_name"), F.lit("N/A")).alias("column_name"),
        "status", "message",
        (F.current_timestamp() if stamp is None else stamp).alias("executed_at"))


# --- the declared suite -----------------------------------------------------------

def _nn(model: str, *cols: str) -> list[Check]:
    return [Check("not_null", model, c) for c in cols]


def _un(model: str, *cols: str) -> list[Check]:
    return [Check("unique", model, c) for c in cols]


# The declared tests of the staging and mart models.
def declared_checks(include_catalog: bool = True) -> list[Check]:
    checks: list[Check] = []
    # staging
    for model, key in (("stg_agencies", "agency_id"), ("stg_clients", "client_id"),
                       ("stg_employees", "employee_id")):
        checks += _un(model, key) + _nn(model, key)
    checks += _nn("stg_employee_agency", "employee_id", "agency_id")
    checks += _un("stg_accounts", "account_id") + _nn("stg_accounts", "account_id", "client_id")
    checks.append(Check("relationships", "stg_accounts", "client_id", to="stg_clients",
                        to_column="client_id", severity="warn"))
    checks += _un("stg_proposals", "proposal_id") + _nn("stg_proposals", "proposal_id", "client_id")
    checks.append(Check("relationships", "stg_proposals", "client_id", to="stg_clients",
                        to_column="client_id", severity="warn"))
    checks.append(Check("accepted_values", "stg_proposals", "proposal_status",
                        values=PROPOSAL_STATUSES))
    checks += _un("stg_transactions", "transaction_id")
    checks += _nn("stg_transactions", "transaction_id", "account_id")
    checks.append(Check("relationships", "stg_transactions", "account_id", to="stg_accounts",
                        to_column="account_id"))
    # marts
    checks.append(Check("unique_combination", "credit_funnel", columns=("month", "proposal_status")))
    checks += _nn("credit_funnel", "month", "proposal_status")
    checks += _un("agency_performance", "agency_sk") + _nn("agency_performance", "agency_sk")
    checks.append(Check("unique_combination", "daily_volume",
                        columns=("transaction_date", "transaction_type")))
    checks += _nn("daily_volume", "transaction_date", "transaction_type")
    checks += _un("account_activity", "account_sk") + _nn("account_activity", "account_sk")
    checks.append(Check("accepted_values", "account_activity", "activity_status",
                        values=ACTIVITY_STATUSES))
    checks.append(Check("expression", "credit_kpis",
                        expression="total_proposals = approved_proposals + rejected_proposals"))
    checks += _nn("credit_kpis", "total_proposals", "approval_rate_pct")
    checks.append(Check("range", "credit_kpis", "approval_rate_pct", min_value=0, max_value=100))
    checks += _nn("credit_kpis", "total_financed_amount")
    if include_catalog:
        checks += _un("model_catalog", "model_name")
        checks += _nn("model_catalog", "model_name", "schema_name", "medallion_layer")
    checks += _nn("quality_dashboard", "model_name", "status")
    checks += _un("cross_sell", "client_fk")
    checks += _nn("cross_sell", "client_fk", "account_fk", "total_balance")
    checks += _un("client_engagement", "client_sk") + _nn("client_engagement", "client_sk")
    checks += _nn("client_engagement", "account_count")
    checks.append(Check("range", "client_engagement", "account_count", min_value=1))
    checks += _nn("client_engagement", "transaction_count")
    checks.append(Check("range", "client_engagement", "transaction_count", min_value=0))
    checks += _nn("client_engagement", "engagement_status")
    checks.append(Check("accepted_values", "client_engagement", "engagement_status",
                        values=ENGAGEMENT_STATUSES))
    checks += _nn("client_engagement", "has_approved_credit")
    checks.append(Check("expression", "commercial_kpis",
                        expression="total_clientes = clientes_ativos + clientes_em_risco "
                                   "+ clientes_churned + clientes_sem_uso"))
    checks += _nn("commercial_kpis", "total_clientes")
    checks.append(Check("range", "commercial_kpis", "total_clientes", min_value=1))
    for col in ("taxa_ativos_pct", "taxa_inativos_pct"):
        checks += _nn("commercial_kpis", col)
        checks.append(Check("range", "commercial_kpis", col, min_value=0, max_value=100))
    checks += _un("driver_ranking", "driver") + _nn("driver_ranking", "driver")
    checks += _un("driver_ranking", "impact_rank") + _nn("driver_ranking", "impact_rank")
    checks += _nn("driver_ranking", "sample_size")
    checks.append(Check("accepted_values", "driver_ranking", "direction",
                        values=DIRECTIONS))
    return checks


# --- live quality dashboard (M-10) --------------------------------------------

def _key_profile(model: str, df: DataFrame, key: str) -> DataFrame:
    """NULL keys and duplicated keys of one table from a single grouped aggregate.

    Duplicates are counted per key value with NULLs grouped together (a plain
    GROUP BY ... HAVING count > 1), unlike the generic ``unique`` test.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).cast("long").alias("nulls"),
        F.count_if(F.col("n") > 1).cast("long").alias("dups"),
    ).select(F.lit(model).alias("model_name"), F.lit(key).alias("column_name"), "nulls", "dups")


def quality_dashboard(clients: DataFrame, agencies: DataFrame, accounts: DataFrame,
                      proposals: DataFrame, strict_parity: bool = False) -> DataFrame:
    """M-10: ten live checks as ``(model_name, column_name, test_type, status, failure_count, message)``.

    Orphan accounts and proposals (client id without a client, a NULL id
    included), NULL keys and duplicated keys of four tables. The two orphan
    checks pass at zero like the others; with ``strict_parity`` they report
    ``FAIL`` whatever the count.
    Sorted by status descending (PASS before FAIL), then model and column.
    """
    def orphans(model: str, df: DataFrame, noun: str) -> DataFrame:
        missing = orphan_total(df, "client_id", clients, "client_id")
        n = F.col("__n")
        status = F.lit(DASH_FAIL) if strict_parity else \
            F.when(n == 0, F.lit(DASH_PASS)).otherwise(F.lit(DASH_FAIL))
        return missing.select(
            F.lit(model).alias("model_name"), F.lit("client_id").alias("column_name"),
            F.lit("relationships").alias("test_type"), status.alias("status"),
            n.alias("failure_count"),
            F.format_string(ORPHAN_MESSAGE, n, F.lit(noun)).alias("message"))

    tables = {"stg_clients": clients, "stg_agencies": agencies, "stg_proposals": proposals,
              "stg_accounts": accounts}
    profiles = reduce(DataFrame.unionByName,
                      [_key_profile(model, tables[model], key) for model, key in _PROFILED])
    parts = [orphans(model, tables[model], noun) for model, noun in _REFERRING]

    def outcome(n: Column) -> Column:
        return F.when(n == 0, F.lit(DASH_PASS)).otherwise(F.lit(DASH_FAIL))

    nulls = profiles.select(
        "model_name", "column_name", F.lit("not_null").alias("test_type"),
        outcome(F.col("nulls")).alias("status"), F.col("nulls").alias("failure_count"),
        F.format_string(NULL_MESSAGE, F.col("column_name")).alias("message"))
    dups = profiles.select(
        "model_name", "column_name", F.lit("unique").alias("test_type"),
        outcome(F.col("dups")).alias("status"), F.col("dups").alias("failure_count"),
        F.format_string(UNIQUE_MESSAGE, F.col("column_name")).alias("message"))
    return (reduce(DataFrame.unionByName, parts + [nulls, dups])
            .orderBy(F.col("status").desc_nulls_first(), F.col("model_name").asc_nulls_last(),
                     F.col("column_name").asc_nulls_last(), F.col("test_type").asc_nulls_last()))


#: Tables of the dashboard whose key is profiled, and tables checked for orphans with their noun.
_PROFILED = (("stg_clients", "client_id"), ("stg_agencies", "agency_id"),
             ("stg_proposals", "proposal_id"), ("stg_accounts", "account_id"))
_REFERRING = (("stg_accounts", "account"), ("stg_proposals", "proposal"))


def quality_dashboard_view(name: str = "marts.quality_dashboard", db: str = "staging") -> str:
    """K-04: the ``CREATE OR REPLACE VIEW`` text of M-10, so that it is live: every read
    counts the staging layer as it is then."""
    row = ("SELECT '{model}' AS model_name, '{key}' AS column_name, '{test}' AS test_type, "
           "if({n} = 0, '" + DASH_PASS + "', '" + DASH_FAIL + "') AS status, "
           "CAST({n} AS BIGINT) AS failure_count, format_string('{message}', {value}) AS message "
           "FROM {source}")
    parts = []
    for model, noun in _REFERRING:
        source = (f"(SELECT coalesce(sum(held), 0) AS n FROM (SELECT client_id, count(*) AS held "
                  f"FROM {db}.{model} GROUP BY client_id) child LEFT ANTI JOIN {db}.stg_clients known "
                  f"ON child.client_id = known.client_id) orphans")
        parts.append(row.format(model=model, key="client_id", test="relationships", n="n",
                                message=ORPHAN_MESSAGE, value=f"n, '{noun}'", source=source))
    for model, key in _PROFILED:
        source = (f"(SELECT coalesce(sum(if({key} IS NULL, held, 0)), 0) AS nulls, "
                  f"count_if(held > 1) AS dups FROM (SELECT {key}, count(*) AS held "
                  f"FROM {db}.{model} GROUP BY {key}) per_key) profile")
        for test, n, message in (("not_null", "nulls", NULL_MESSAGE),
                                 ("unique", "dups", UNIQUE_MESSAGE)):
            parts.append(row.format(model=model, key=key, test=test, n=n, message=message,
                                    value=f"'{key}'", source=source))
    return (f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM (" + " UNION ALL ".join(parts)
            + ") ORDER BY status DESC NULLS FIRST, model_name, column_name, test_type")


# --- load checks (L-01 … L-08) ----------------------------------------------------

def table_counts(tables: Mapping[str, DataFrame], label: str = "row_count") -> DataFrame:
    """``(table_name, <label>)``: one count per table, all in one unioned job."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).cast("long").alias(label))
        .select(F.lit(name).alias("table_name"), label)
        for name, df in tables.items()])


def check_row_parity(source: Mapping[str, DataFrame], raw: Mapping[str, DataFrame]) -> DataFrame:
    """L-01: source rows = raw rows per table."""
    s = table_counts(source, "source_rows")
    r = table_counts(raw, "raw_rows")
    return (s.join(r, "table_name", "full")
            .withColumn("status", F.when(F.col("source_rows") == F.col("raw_rows"), F.lit(PASS))
                        .otherwise(F.lit(FAIL))))


def csv_records(spark, path: str, multiline: bool = True) -> DataFrame:
    """L-01 for one or several files: data records (quoted newlines and each file's header
    understood), counted distributed."""
    from ledgerlake.sources.readers import csv_texts_table

    return csv_texts_table(spark, path, multiline=multiline).agg(F.count(F.lit(1)).alias("csv_rows"))


def check_values_not_null(tables: Mapping[str, DataFrame],
                          columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """L-06: rows with a NULL value, per table and column (``null_values``, ``status``)."""
    counted = reduce(DataFrame.unionByName, [
        tables[t].agg(F.count_if(F.col(c).isNull()).cast("long").alias("null_values"))
        .select(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "null_values")
        for t, cs in columns.items() for c in cs])
    return counted.withColumn("status", F.when(F.col("null_values") == 0, F.lit(PASS))
                              .otherwise(F.lit(FAIL)))


def check_pk_not_null(tables: Mapping[str, DataFrame],
                      keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """L-02: rows with any NULL key column, per table (composite keys included)."""
    return reduce(DataFrame.unionByName, [
        tables[t].agg(F.count_if(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in ks]))
                      .cast("long").alias("null_keys"))
        .select(F.lit(t).alias("table_name"), "null_keys")
        for t, ks in keys.items() if t in tables])


def check_pk_duplicates(tables: Mapping[str, DataFrame],
                        keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """L-03: ``count(*) - count(distinct key)`` per table."""
    out = []
    for t, ks in keys.items():
        if t not in tables:
            continue
        df = tables[t]
        out.append(df.agg((F.count(F.lit(1)) - F.count_distinct(*[F.col(k) for k in ks]))
                          .cast("long").alias("duplicate_keys"))
                   .select(F.lit(t).alias("table_name"), "duplicate_keys"))
    return reduce(DataFrame.unionByName, out)


def content_fingerprint(df: DataFrame) -> DataFrame:
    """One row: row count and an order-insensitive content hash (sum of row hashes).

    Each column is hashed with its NULL flag: a NULL leaves the hash of a row
    as it was, so without the flag swapped columns would hash alike.
    """
    parts = [x for c in df.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    row_hash = F.xxhash64(*parts).cast("decimal(20,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_hash).alias("content_hash"))


def check_expected_counts(tables: Mapping[str, DataFrame], expected: Mapping[str, int]) -> DataFrame:
    """L-05: table count equals a given constant."""
    counts = table_counts({t: tables[t] for t in expected})
    spark = counts.sparkSession
    exp = spark.createDataFrame(list(expected.items()), "table_name string, expected_rows long")
    return (counts.join(F.broadcast(exp), "table_name")
            .withColumn("status", F.when(F.col("row_count") == F.col("expected_rows"), F.lit(PASS))
                        .otherwise(F.lit(FAIL))))


def check_rank_dense(df: DataFrame, column: str) -> DataFrame:
    """L-07: ranks are exactly 1..N (min 1, max N, N distinct)."""
    return df.agg(F.min(column).cast("long").alias("min_rank"),
                  F.max(column).cast("long").alias("max_rank"),
                  F.count(F.lit(1)).alias("total"),
                  F.count_distinct(column).alias("distinct_ranks")).withColumn(
        "is_dense",
        F.coalesce((F.col("min_rank") == 1) & (F.col("max_rank") == F.col("total"))
                   & (F.col("distinct_ranks") == F.col("total")), F.col("total") == 0))


def check_single_row(df: DataFrame) -> DataFrame:
    """L-08: exactly one row."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "is_single_row", F.col("row_count") == 1)


def assert_checks_pass(results: DataFrame, allowed: Iterable[str] = (PASS, WARN)) -> None:
    """Raise listing every test whose status is not allowed."""
    bad = results.where(~F.col("status").isin(*allowed)).collect()  # a row per failed test
    if bad:
        raise AssertionError("failed checks: " + ", ".join(
            f"{r['test_name']}={r['failures']}" for r in bad))


def check_idempotent_reload(spark, tables: Mapping[str, DataFrame], db: str = "raw") -> DataFrame:
    """L-04: full-refresh ``tables`` into ``db`` twice; row counts and content hashes must agree.

    ``(table_name, rows_first, rows_second, hash_first, hash_second, status)``,
    one row per table. The fingerprints are computed on the written tables,
    so the comparison covers what a second run actually leaves behind.
    """
    from ledgerlake.sources.sinks import full_refresh

    def fingerprints() -> dict:
        return {t: content_fingerprint(spark.table(f"{db}.{t}")).collect()[0] for t in tables}

    full_refresh(spark, tables, db)
    first = fingerprints()
    full_refresh(spark, tables, db)
    second = fingerprints()
    rows = [(t, first[t]["rows"], second[t]["rows"], first[t]["content_hash"],
             second[t]["content_hash"]) for t in tables]
    out = spark.createDataFrame(rows, "table_name string, rows_first long, rows_second long, "
                                      "hash_first decimal(38,0), hash_second decimal(38,0)")
    same = ((F.col("rows_first") == F.col("rows_second"))
            & F.col("hash_first").eqNullSafe(F.col("hash_second")))
    return out.withColumn("status", F.when(same, F.lit(PASS)).otherwise(F.lit(FAIL)))
