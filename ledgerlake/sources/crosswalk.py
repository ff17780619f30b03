"""Crosswalk: the driver's test tables presented as the bank's raw layer.

The test data is a TPC-H-like star schema. Each raw table is derived from it
with a fixed column mapping (``FIXTURES.md`` section 3); columns without a
counterpart are typed NULLs. Everything here is lazy DataFrame code, so the
scans are pruned to the columns the downstream model actually uses.

Mapping (driver -> raw):

Joins are left joins: a row without its partner is kept, so that the checks
for orphans see it.

* agencias: nation joined to region (agency = nation, type = region name)
* clientes: customer, onboarding = first order date of the customer; the
  customer name ``Prefix#Number`` is split into first and last name
* colaboradores, colaborador_agencia: supplier (agency = supplier nation)
* contas: orders joined to customer (account = order, agency = customer nation)
* propostas_credito: every line item joined to its order (proposal id =
  orderkey * 10 + linenumber); status from the return flag and quantity
* transacoes: lineitem (id = orderkey * 10 + linenumber, account = order) or,
  for the daily-volume views, the ``events`` table
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.fees import fee_table
from ledgerlake.schemas import MONEY, RATE

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem", "events",
                 "documents", "labels")

# Declared schemas of the driver's tables: reading with a schema skips the
# footer-sampling job that schema inference would run for every read.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
              "props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
}

# Proposal status of a line item. Of the returned lines only
# those of a large quantity count as approved, so that some clients have an
# approved proposal and some none, though every line is a proposal.
APPROVED_ABOVE_QUANTITY = 45
STATUS_OF_LINE = (f"CASE WHEN l_returnflag = 'R' AND l_quantity > {APPROVED_ABOVE_QUANTITY} "
                  "THEN 'Aprovada' WHEN l_returnflag = 'R' THEN 'Validação documentos' "
                  "WHEN l_returnflag = 'A' THEN 'Em análise' "
                  "WHEN l_returnflag = 'N' THEN 'Enviada' END")


def _project(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """One projection from ``(SQL expression, output name)`` pairs."""
    return df.selectExpr(*[f"{expr} AS {name}" for expr, name in columns])


class DriverTables:
    """Lazy readers of the driver's Parquet tables in one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        path = os.path.join(self.folder, f"{name}.parquet")
        reader = self.spark.read
        if name in DRIVER_SCHEMAS:
            reader = reader.schema(DRIVER_SCHEMAS[name])
        return reader.parquet(path)


def _one_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """``value`` of each key as an aggregate, which proves to the optimizer that keys are unique:
    a left join to it is dropped wherever the value isn't read."""
    return df.groupBy(key).agg(F.min(value).alias(value))


def raw_agencias(d: DriverTables) -> DataFrame:
    nation = d.table("nation")
    region = d.table("region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    return _project(joined, [
        ("CAST(n_nationkey AS BIGINT)", "cod_agencia"),
        ("n_name", "nome"),
        ("CAST(NULL AS STRING)", "endereco"),
        ("CAST(NULL AS STRING)", "cidade"),
        ("CAST(NULL AS STRING)", "uf"),
        ("CAST(NULL AS DATE)", "data_abertura"),
        ("r_name", "tipo_agencia"),
    ])


def raw_clientes(d: DriverTables) -> DataFrame:
    # First order per customer, pre-aggregated so only one row per customer
    # crosses the join.
    first_order = (d.table("orders").groupBy("o_custkey")
                   .agg(F.min("o_orderdate").alias("first_order_at")))
    customer = d.table("customer")
    joined = customer.join(first_order, customer.c_custkey == first_order.o_custkey, "left")
    return _project(joined, [
        ("c_custkey", "cod_cliente"),
        (r"regexp_extract(c_name, '^([^#]*)', 1)", "primeiro_nome"),
        (r"regexp_extract(c_name, '#(.*)$', 1)", "ultimo_nome"),
        ("CAST(NULL AS STRING)", "email"),
        ("c_mktsegment", "tipo_cliente"),
        ("CAST(first_order_at AS TIMESTAMP)", "data_inclusao"),
        ("CAST(NULL AS STRING)", "cpfcnpj"),
        ("CAST(NULL AS DATE)", "data_nascimento"),
        ("CAST(NULL AS STRING)", "endereco"),
        ("CAST(NULL AS STRING)", "cep"),
    ])


def raw_colaboradores(d: DriverTables) -> DataFrame:
    return _project(d.table("supplier"), [
        ("s_suppkey", "cod_colaborador"),
        ("s_name", "primeiro_nome"),
        ("CAST(NULL AS STRING)", "ultimo_nome"),
        ("CAST(NULL AS STRING)", "email"),
        ("CAST(NULL AS STRING)", "cpf"),
        ("CAST(NULL AS DATE)", "data_nascimento"),
        ("CAST(NULL AS STRING)", "endereco"),
        ("CAST(NULL AS STRING)", "cep"),
    ])


def raw_colaborador_agencia(d: DriverTables) -> DataFrame:
    return _project(d.table("supplier"), [
        ("s_suppkey", "cod_colaborador"),
        ("CAST(s_nationkey AS BIGINT)", "cod_agencia"),
    ])


def raw_contas(d: DriverTables) -> DataFrame:
    orders = d.table("orders")
    customer = _one_per_key(d.table("customer"), "c_custkey", "c_nationkey")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
    return _project(joined, [
        ("o_orderkey", "num_conta"),
        ("o_custkey", "cod_cliente"),
        ("CAST(c_nationkey AS BIGINT)", "cod_agencia"),
        ("CAST(NULL AS BIGINT)", "cod_colaborador"),
        ("o_orderpriority", "tipo_conta"),
        ("CAST(o_orderdate AS TIMESTAMP)", "data_abertura"),
        (f"CAST(o_totalprice AS {MONEY.simpleString()})", "saldo_total"),
        (f"CAST(NULL AS {MONEY.simpleString()})", "saldo_disponivel"),
        ("CAST(NULL AS TIMESTAMP)", "data_ultimo_lancamento"),
    ])


def raw_propostas_credito(d: DriverTables) -> DataFrame:
    lines = d.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate",
                                       "l_discount", "l_extendedprice", "l_quantity",
                                       "l_returnflag")
    orders = _one_per_key(d.table("orders"), "o_orderkey", "o_custkey")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left")
    money = MONEY.simpleString()
    return _project(joined, [
        ("l_orderkey * 10 + l_linenumber", "cod_proposta"),
        ("o_custkey", "cod_cliente"),
        ("l_suppkey", "cod_colaborador"),
        ("CAST(l_shipdate AS TIMESTAMP)", "data_entrada_proposta"),
        (f"CAST(l_discount AS {RATE.simpleString()})", "taxa_juros_mensal"),
        (f"CAST(l_extendedprice AS {money})", "valor_proposta"),
        (f"CAST(NULL AS {money})", "valor_financiamento"),
        (f"CAST(NULL AS {money})", "valor_entrada"),
        (f"CAST(NULL AS {money})", "valor_prestacao"),
        ("CAST(NULL AS INT)", "quantidade_parcelas"),
        ("CAST(NULL AS INT)", "carencia"),
        (STATUS_OF_LINE, "status_proposta"),
    ])


def raw_transacoes(d: DriverTables, source: str = "lineitem") -> DataFrame:
    """Transactions in landed (untyped-name) form; staging casts them.

    The values keep the driver's native types: casting them to text only for
    staging to parse them back would be pure overhead, and staging's casts
    are no-ops (or an exact double -> decimal cast) on typed input.
    """
    if source == "lineitem":
        return _project(d.table("lineitem"), [
            ("l_orderkey * 10 + l_linenumber", "cod_transacao"),
            ("l_orderkey", "num_conta"),
            ("CAST(l_shipdate AS TIMESTAMP)", "data_transacao"),
            ("l_returnflag", "nome_transacao"),
            ("l_extendedprice", "valor_transacao"),
        ])
    if source == "events":
        return _project(d.table("events"), [
            ("event_id", "cod_transacao"),
            ("user_id", "num_conta"),
            ("CAST(ts AS TIMESTAMP)", "data_transacao"),
            ("event_type", "nome_transacao"),
            ("value", "valor_transacao"),
        ])
    raise ValueError(f"unknown transaction source {source!r}")


# Fees of the transaction types that the driver's tables have; one type has none.
DRIVER_FEES = [
    ("A", "12.00", "0.000", "fixed"),
    ("N", "0.00", "0.000", "free"),
    ("R", "2.50", "0.015", "fixed and a share of the amount"),
]


RAW_BUILDERS = {
    "agencias": raw_agencias,
    "clientes": raw_clientes,
    "colaboradores": raw_colaboradores,
    "colaborador_agencia": raw_colaborador_agencia,
    "contas": raw_contas,
    "propostas_credito": raw_propostas_credito,
    "transacoes": raw_transacoes,
}


class RawLayer:
    """Lazily built raw tables from a driver folder; each table is built on first use."""

    def __init__(self, spark: SparkSession, folder: str, tx_source: str = "lineitem"):
        self.driver = DriverTables(spark, folder)
        self.tx_source = tx_source
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name == "tarifas_transacao":
                self._cache[name] = fee_table(self.driver.spark, DRIVER_FEES)
            elif name == "transacoes":
                self._cache[name] = raw_transacoes(self.driver, self.tx_source)
            else:
                self._cache[name] = RAW_BUILDERS[name](self.driver)
        return self._cache[name]

    def as_dict(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in RAW_BUILDERS}
