"""Staging (silver) models: rename raw columns to English and type them.

Each model is declared once as a projection spec (raw table + ``(SQL
expression, output name)`` pairs). The same spec builds the DataFrame (for
lazy, inlined use: Catalyst then prunes the raw scan to the columns actually
used downstream) and the permanent ``CREATE VIEW`` of the staging layer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.schemas import MONEY

# model -> (raw table, [(expression over the raw columns, output column)])
STAGING_SPECS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "stg_agencies": ("agencias", [
        ("cod_agencia", "agency_id"),
        ("nome", "agency_name"),
        ("endereco", "address"),
        ("cidade", "city"),
        ("uf", "state"),
        ("data_abertura", "opening_date"),
        ("tipo_agencia", "agency_type"),
    ]),
    # The full name is NULL when either name part is NULL (concat propagates NULL).
    "stg_clients": ("clientes", [
        ("cod_cliente", "client_id"),
        ("concat(primeiro_nome, ' ', ultimo_nome)", "client_full_name"),
        ("email", "email"),
        ("tipo_cliente", "client_type"),
        ("data_inclusao", "onboarding_date"),
        ("cpfcnpj", "cpf_cnpj"),
        ("data_nascimento", "birth_date"),
        ("endereco", "address"),
        ("cep", "postal_code"),
    ]),
    "stg_employees": ("colaboradores", [
        ("cod_colaborador", "employee_id"),
        ("primeiro_nome", "first_name"),
        ("ultimo_nome", "last_name"),
        ("email", "email"),
        ("cpf", "cpf"),
        ("data_nascimento", "birth_date"),
        ("endereco", "address"),
        ("cep", "postal_code"),
    ]),
    "stg_employee_agency": ("colaborador_agencia", [
        ("cod_colaborador", "employee_id"),
        ("cod_agencia", "agency_id"),
    ]),
    "stg_accounts": ("contas", [
        ("num_conta", "account_id"),
        ("cod_cliente", "client_id"),
        ("cod_agencia", "agency_id"),
        ("cod_colaborador", "employee_id"),
        ("tipo_conta", "account_type"),
        ("data_abertura", "opening_date"),
        ("saldo_total", "total_balance"),
        ("saldo_disponivel", "available_balance"),
        ("data_ultimo_lancamento", "last_posting_date"),
    ]),
    "stg_proposals": ("propostas_credito", [
        ("cod_proposta", "proposal_id"),
        ("cod_cliente", "client_id"),
        ("cod_colaborador", "employee_id"),
        ("data_entrada_proposta", "proposal_date"),
        ("taxa_juros_mensal", "monthly_interest_rate"),
        ("valor_proposta", "proposal_amount"),
        ("valor_financiamento", "financing_amount"),
        ("valor_entrada", "down_payment"),
        ("valor_prestacao", "installment_amount"),
        ("quantidade_parcelas", "installment_count"),
        ("carencia", "grace_period"),
        ("status_proposta", "proposal_status"),
    ]),
    # The transactions extract is landed as text. Casts run under ANSI rules,
    # so a malformed value fails the query rather than silently becoming NULL;
    # ``transaction_cast_report`` counts such rows first.
    "stg_transactions": ("transacoes", [
        ("CAST(cod_transacao AS BIGINT)", "transaction_id"),
        ("CAST(num_conta AS BIGINT)", "account_id"),
        ("CAST(data_transacao AS TIMESTAMP)", "transaction_at"),
        ("nome_transacao", "transaction_type"),
        (f"CAST(valor_transacao AS {MONEY.simpleString()})", "transaction_amount"),
    ]),
}


def stage(name: str, raw: DataFrame) -> DataFrame:
    """Apply the projection of staging model ``name`` to its raw table."""
    _, columns = STAGING_SPECS[name]
    return raw.selectExpr(*[f"{e} AS {out}" for e, out in columns])


def view_sql(name: str, raw_db: str = "raw", staging_db: str = "staging") -> str:
    """``CREATE OR REPLACE VIEW`` statement of staging model ``name``."""
    table, columns = STAGING_SPECS[name]
    select = ",\n    ".join(f"{e} AS {out}" for e, out in columns)
    return (f"CREATE OR REPLACE VIEW {staging_db}.{name} AS\nSELECT\n    {select}\n"
            f"FROM {raw_db}.{table}")


def stg_agencies(raw: DataFrame) -> DataFrame:
    """T-01: agencies."""
    return stage("stg_agencies", raw)


def stg_clients(raw: DataFrame) -> DataFrame:
    """T-02: clients; full name = first || ' ' || last."""
    return stage("stg_clients", raw)


def stg_employees(raw: DataFrame) -> DataFrame:
    """T-03: employees."""
    return stage("stg_employees", raw)


def stg_employee_agency(raw: DataFrame) -> DataFrame:
    """T-04: employee-agency bridge (N:N)."""
    return stage("stg_employee_agency", raw)


def stg_accounts(raw: DataFrame) -> DataFrame:
    """T-05: accounts."""
    return stage("stg_accounts", raw)


def stg_proposals(raw: DataFrame) -> DataFrame:
    """T-06: credit proposals."""
    return stage("stg_proposals", raw)


def stg_transactions(raw: DataFrame) -> DataFrame:
    """T-07: transactions, cast from the landed text (no-op casts on typed input)."""
    return stage("stg_transactions", raw)


def transaction_cast_report(raw: DataFrame) -> DataFrame:
    """One row: per typed column, present values that do not cast; amounts that lose scale.

    A single aggregate over the landed table (one scan, partial aggregation
    on every task); it never fails, so it can run before the strict cast.
    """
    targets = [("cod_transacao", "transaction_id", T.LongType()),
               ("num_conta", "account_id", T.LongType()),
               ("data_transacao", "transaction_at", T.TimestampType()),
               ("valor_transacao", "transaction_amount", MONEY)]
    aggs = [F.count_if(F.col(src).isNotNull() & F.col(src).try_cast(dtype).isNull())
            .alias(f"bad_{dst}") for src, dst, dtype in targets]
    wide = F.col("valor_transacao").try_cast(T.DecimalType(38, 10))
    narrow = F.col("valor_transacao").try_cast(MONEY)
    aggs.append(F.count_if(wide.isNotNull() & narrow.isNotNull() & (wide != narrow))
                .alias("scale_loss_transaction_amount"))
    aggs.append(F.count(F.lit(1)).alias("total_rows"))
    return raw.agg(*aggs)
