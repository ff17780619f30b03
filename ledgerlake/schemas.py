"""Explicit schemas of the raw layer and the metadata tables.

Raw sources are read with these schemas (never inferred). Column order is the
CSV column order of the source extracts.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(18, 8)

# Column names and types of the source tables.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "agencias": T.StructType([
        T.StructField("cod_agencia", T.IntegerType()),
        T.StructField("nome", T.StringType()),
        T.StructField("endereco", T.StringType()),
        T.StructField("cidade", T.StringType()),
        T.StructField("uf", T.StringType()),
        T.StructField("data_abertura", T.DateType()),
        T.StructField("tipo_agencia", T.StringType()),
    ]),
    "clientes": T.StructType([
        T.StructField("cod_cliente", T.IntegerType()),
        T.StructField("primeiro_nome", T.StringType()),
        T.StructField("ultimo_nome", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("tipo_cliente", T.StringType()),
        T.StructField("data_inclusao", T.TimestampType()),
        T.StructField("cpfcnpj", T.StringType()),
        T.StructField("data_nascimento", T.DateType()),
        T.StructField("endereco", T.StringType()),
        T.StructField("cep", T.StringType()),
    ]),
    "colaboradores": T.StructType([
        T.StructField("cod_colaborador", T.IntegerType()),
        T.StructField("primeiro_nome", T.StringType()),
        T.StructField("ultimo_nome", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("cpf", T.StringType()),
        T.StructField("data_nascimento", T.DateType()),
        T.StructField("endereco", T.StringType()),
        T.StructField("cep", T.StringType()),
    ]),
    "colaborador_agencia": T.StructType([
        T.StructField("cod_colaborador", T.IntegerType()),
        T.StructField("cod_agencia", T.IntegerType()),
    ]),
    "contas": T.StructType([
        T.StructField("num_conta", T.IntegerType()),
        T.StructField("cod_cliente", T.IntegerType()),
        T.StructField("cod_agencia", T.IntegerType()),
        T.StructField("cod_colaborador", T.IntegerType()),
        T.StructField("tipo_conta", T.StringType()),
        T.StructField("data_abertura", T.TimestampType()),
        T.StructField("saldo_total", MONEY),
        T.StructField("saldo_disponivel", MONEY),
        T.StructField("data_ultimo_lancamento", T.TimestampType()),
    ]),
    "propostas_credito": T.StructType([
        T.StructField("cod_proposta", T.IntegerType()),
        T.StructField("cod_cliente", T.IntegerType()),
        T.StructField("cod_colaborador", T.IntegerType()),
        T.StructField("data_entrada_proposta", T.TimestampType()),
        T.StructField("taxa_juros_mensal", RATE),
        T.StructField("valor_proposta", MONEY),
        T.StructField("valor_financiamento", MONEY),
        T.StructField("valor_entrada", MONEY),
        T.StructField("valor_prestacao", MONEY),
        T.StructField("quantidade_parcelas", T.IntegerType()),
        T.StructField("carencia", T.IntegerType()),
        T.StructField("status_proposta", T.StringType()),
    ]),
    # The transactions extract is landed as text; staging casts it.
    "transacoes": T.StructType([
        T.StructField("cod_transacao", T.StringType()),
        T.StructField("num_conta", T.StringType()),
        T.StructField("data_transacao", T.StringType()),
        T.StructField("nome_transacao", T.StringType()),
        T.StructField("valor_transacao", T.StringType()),
    ]),
}

# Declared primary keys of the source tables (the bridge has a composite key).
RAW_KEYS: dict[str, tuple[str, ...]] = {
    "agencias": ("cod_agencia",),
    "clientes": ("cod_cliente",),
    "colaboradores": ("cod_colaborador",),
    "colaborador_agencia": ("cod_colaborador", "cod_agencia"),
    "contas": ("num_conta",),
    "propostas_credito": ("cod_proposta",),
    "transacoes": ("cod_transacao",),
}

# Tables served by the relational source; the last raw table comes from CSV.
RELATIONAL_TABLES = ("agencias", "clientes", "colaboradores", "colaborador_agencia",
                     "contas", "propostas_credito")
CSV_TABLES = ("transacoes",)
RAW_TABLES = RELATIONAL_TABLES + CSV_TABLES

# Columns of the two audit tables.
TEST_RESULTS_SCHEMA = T.StructType([
    T.StructField("test_name", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("executed_at", T.TimestampType()),
])

MODEL_RUNS_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("materialization", T.StringType()),
    T.StructField("schema_name", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("executed_at", T.TimestampType()),
])
