"""Readers, staging casts, the load gate and the full refresh."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest

from ledgerlake.operators import staging as stg
from ledgerlake.operators.quality import content_fingerprint, csv_records
from ledgerlake.schemas import RAW_SCHEMAS
from ledgerlake.sources.gate import validate_load
from ledgerlake.sources.readers import jdbc_options, read_csv_table, read_jdbc_table
from ledgerlake.sources.sinks import full_refresh


def _write(path: str, text: str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_transactions_csv_text_and_utc_edges(spark, scratch):
    path = _write(os.path.join(scratch, "csv1", "transacoes.csv"),
                  "cod_transacao,num_conta,data_transacao,nome_transacao,valor_transacao\n"
                  "1,10,2022-12-31 23:59:59,Pix,10.50\n"
                  "2,10,2023-01-01 00:00:00,Pix,1e3\n"
                  "3,11,2023-01-01 00:30:00+01:00,Saque,7\n"
                  "4,11,2022-12-31 23:59:59 UTC,Saque,1.00\n")
    raw = read_csv_table(spark, path, RAW_SCHEMAS["transacoes"])
    assert [f.dataType.simpleString() for f in raw.schema.fields] == ["string"] * 5
    rows = {r["transaction_id"]: r for r in stg.stg_transactions(raw).collect()}
    assert rows[1]["transaction_at"] == dt.datetime(2022, 12, 31, 23, 59, 59)
    assert rows[3]["transaction_at"] == dt.datetime(2022, 12, 31, 23, 30, 0)
    assert rows[4]["transaction_at"] == dt.datetime(2022, 12, 31, 23, 59, 59)
    assert rows[2]["transaction_amount"] == Decimal("1000.00")
    from ledgerlake.operators.volume import daily_volume
    days = {(r["transaction_date"], r["transaction_type"]): r["transaction_count"]
            for r in daily_volume(stg.stg_transactions(raw)).collect()}
    assert days == {(dt.date(2022, 12, 31), "Pix"): 1, (dt.date(2023, 1, 1), "Pix"): 1,
                    (dt.date(2022, 12, 31), "Saque"): 2}


def test_malformed_amounts_counted_then_fail(spark, scratch):
    path = _write(os.path.join(scratch, "csv2", "transacoes.csv"),
                  "cod_transacao,num_conta,data_transacao,nome_transacao,valor_transacao\n"
                  "1,10,2022-12-31 10:00:00,Pix,abc\n"
                  "2,10,2022-12-31 10:00:00,Pix,\n"
                  "3,10,2022-12-31 10:00:00,Pix,1e3\n"
                  "4,10,2022-12-31 10:00:00,Pix,1234.567\n")
    raw = read_csv_table(spark, path, RAW_SCHEMAS["transacoes"])
    report = stg.transaction_cast_report(raw).collect()[0]
    assert report["bad_transaction_amount"] == 1          # 'abc' (empty is NULL, not bad)
    assert report["scale_loss_transaction_amount"] == 1   # 1234.567 -> 1234.57
    assert report["total_rows"] == 4
    with pytest.raises(Exception):
        stg.stg_transactions(raw).collect()


def test_typed_csv_load_and_null_name_part(spark, scratch):
    path = _write(os.path.join(scratch, "csv3", "clientes.csv"),
                  "cod_cliente,primeiro_nome,ultimo_nome,email,tipo_cliente,data_inclusao,"
                  "cpfcnpj,data_nascimento,endereco,cep\n"
                  "1,Ana,Silva,a@x,PF,2020-01-02 03:04:05 UTC,1,1990-05-06,Rua 1,000\n"
                  "2,Bruno,,b@x,PF,2021-01-02 03:04:05+00:00,2,1991-05-06,Rua 2,001\n")
    raw = read_csv_table(spark, path, RAW_SCHEMAS["clientes"])
    assert dict(raw.dtypes)["cod_cliente"] == "int"
    assert dict(raw.dtypes)["data_nascimento"] == "date"
    rows = {r["client_id"]: r for r in stg.stg_clients(raw).collect()}
    assert rows[1]["client_full_name"] == "Ana Silva"
    assert rows[2]["client_full_name"] is None
    assert rows[1]["onboarding_date"] == dt.datetime(2020, 1, 2, 3, 4, 5)


def test_csv_wrong_field_count_fails(spark, scratch):
    path = _write(os.path.join(scratch, "csv4", "colaborador_agencia.csv"),
                  "cod_colaborador,cod_agencia\n1,2\n3,4,5\n")
    with pytest.raises(Exception):
        read_csv_table(spark, path, RAW_SCHEMAS["colaborador_agencia"]).collect()


def test_staging_view_sql_matches_dataframe(spark):
    sql = stg.view_sql("stg_clients")
    assert sql.startswith("CREATE OR REPLACE VIEW staging.stg_clients AS")
    assert "concat(primeiro_nome, ' ', ultimo_nome) AS client_full_name" in sql
    assert "FROM raw.clientes" in sql


def test_jdbc_options_partitioned_and_allow_list(spark):
    opts = jdbc_options("jdbc:postgresql://db/x", "contas", partition_column="num_conta",
                        lower_bound=1, upper_bound=1000, num_partitions=8)
    assert opts["dbtable"] == "public.contas" and opts["numPartitions"] == "8"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:postgresql://db/x", "contas", partition_column="num_conta")
    with pytest.raises(ValueError):
        read_jdbc_table(spark, "jdbc:postgresql://db/x", "pg_authid")


def test_jdbc_reads_are_split_by_numeric_key(spark, monkeypatch):
    from ledgerlake.schemas import RELATIONAL_TABLES
    from ledgerlake.sources import readers

    asked = []

    def bounds(spark, url, table, column, **_):
        asked.append((table, column))
        return (None, None) if table == "agencias" else (5, 104)

    monkeypatch.setattr(readers, "key_bounds", bounds)
    for table in RELATIONAL_TABLES:
        got = readers.key_range_options(spark, "jdbc:x", table, 8)
        if table == "agencias":
            assert got == {}
        else:
            opts = jdbc_options("jdbc:x", table, **got)
            assert (opts["lowerBound"], opts["upperBound"], opts["numPartitions"]) == ("5", "105", "8")
            assert opts["partitionColumn"].startswith(("cod_", "num_"))
    assert len(asked) == len(RELATIONAL_TABLES)
    assert readers.key_range_options(spark, "jdbc:x", "contas", 1) == {}


def test_jdbc_ranges_follow_the_rows(spark, monkeypatch):
    """A sparse key: ranges of equal rows, every row (a NULL key, too) in exactly one."""
    from ledgerlake.sources import readers

    keys = [*range(1, 901), *range(10**9, 10**9 + 100)]
    low = [keys[i * len(keys) // 8] for i in range(8)]
    monkeypatch.setattr(readers, "key_quantiles", lambda *_, **__: low[::-1])
    predicates = readers.key_ranges(spark, "jdbc:x", "contas", 8)
    column = readers.RAW_KEYS["contas"][0]
    rows = spark.createDataFrame([(k,) for k in [*keys, None, -5, 2**40]], f"{column} long")
    held = [rows.where(p).count() for p in predicates]
    assert len(held) == 8 and sum(held) == len(keys) + 3
    assert max(held) <= len(keys) / 8 + 3
    assert sum(rows.where(p).where(f"{column} is null").count() for p in predicates) == 1
    assert readers.key_ranges(spark, "jdbc:x", "contas", 1) == []
    assert readers.range_predicates("k", []) == []
    assert readers.range_predicates("k", [5, 5]) == ["1 = 1"]
    assert readers.range_predicates("k", [5, 5, 7]) == ["k < 7 OR k IS NULL", "k >= 7"]


def test_gate_names_empty_tables(spark):
    full = spark.createDataFrame([(1, 2)], "cod_colaborador int, cod_agencia int")
    empty = spark.createDataFrame([], "cod_agencia int")
    assert validate_load({"colaborador_agencia": full}) == {"colaborador_agencia": 1}
    with pytest.raises(ValueError, match="agencias"):
        validate_load({"colaborador_agencia": full, "agencias": empty})


def test_reload_twice_same_counts_and_hash(spark):
    from ledgerlake.sources.crosswalk import RawLayer
    raw = RawLayer(spark, "/root/testdata/sf0.001").as_dict()
    first = full_refresh(spark, raw, "raw_reload")
    fp1 = {t: content_fingerprint(spark.table(f"raw_reload.{t}")).collect()[0] for t in raw}
    second = full_refresh(spark, raw, "raw_reload")
    fp2 = {t: content_fingerprint(spark.table(f"raw_reload.{t}")).collect()[0] for t in raw}
    assert first == second
    assert fp1 == fp2
    assert first["transacoes"] == 6000


def test_check_idempotent_reload_operator(spark):
    from ledgerlake.operators.quality import check_idempotent_reload
    from ledgerlake.sources.crosswalk import RawLayer
    raw = RawLayer(spark, "/root/testdata/sf0.001").as_dict()
    rows = {r["table_name"]: r for r in check_idempotent_reload(spark, raw, "raw_idem").collect()}
    assert set(rows) == set(raw)
    assert all(r["status"] == "pass" for r in rows.values())
    assert rows["transacoes"]["rows_second"] == 6000


def test_csv_dialect(spark, scratch):
    """Doubled quotes, quoted newlines, a trailing backslash, quoted and unquoted empty fields."""
    path = _write(os.path.join(scratch, "csv5", "clientes.csv"),
                  "cod_cliente,primeiro_nome,ultimo_nome,email,tipo_cliente,data_inclusao,"
                  "cpfcnpj,data_nascimento,endereco,cep\n"
                  '1,Ana,"",a@x,PF,2020-01-02 03:04:05 UTC,1,1990-05-06,"Rua ""A"", 10",000\n'
                  "2,Bruno,,b@x,PF,2021-01-02 03:04:05 UTC,2,1991-05-06,Rua\\,001\n"
                  '3,Caio,"de\nSouza",c@x,PF,2021-01-02 03:04:05 UTC,3,1991-05-06,"C:\\",002\n')
    raw = {r["cod_cliente"]: r for r in read_csv_table(spark, path, RAW_SCHEMAS["clientes"]).collect()}
    assert raw[1]["ultimo_nome"] == "" and raw[2]["ultimo_nome"] is None
    assert raw[1]["endereco"] == 'Rua "A", 10'
    assert raw[2]["endereco"] == "Rua\\" and raw[3]["endereco"] == "C:\\"
    assert raw[3]["ultimo_nome"] == "de\nSouza"


def test_csv_columns_go_by_header_name(spark, scratch):
    folder = os.path.join(scratch, "csv6")
    swapped = _write(os.path.join(folder, "a.csv"), "cod_agencia,extra,cod_colaborador\n7,x,100\n")
    row = read_csv_table(spark, swapped, RAW_SCHEMAS["colaborador_agencia"]).first()
    assert (row["cod_colaborador"], row["cod_agencia"]) == (100, 7)
    missing = _write(os.path.join(folder, "b.csv"), "cod_agencia\n7\n")
    with pytest.raises(ValueError, match="cod_colaborador"):
        read_csv_table(spark, missing, RAW_SCHEMAS["colaborador_agencia"])
    several = os.path.join(folder, "several")
    _write(os.path.join(several, "1.csv"), "cod_colaborador,cod_agencia\n1,2\n3,4\n")
    _write(os.path.join(several, "2.csv"), "cod_colaborador,cod_agencia\n5,6\n7,8\n")
    assert read_csv_table(spark, several, RAW_SCHEMAS["colaborador_agencia"]).count() == 4
    assert csv_records(spark, several).first()["csv_rows"] == 4
    _write(os.path.join(several, "3.csv"), "cod_agencia,cod_colaborador\n9,10\n")
    with pytest.raises(Exception):  # a file whose header names them in another order
        read_csv_table(spark, several, RAW_SCHEMAS["colaborador_agencia"]).collect()


def test_csv_records_understand_quoted_newlines(spark, scratch):
    path = _write(os.path.join(scratch, "csv7", "x.csv"), 'a,b\n1,"x\ny"\n2,z\n')
    assert csv_records(spark, path).first()["csv_rows"] == 2


def test_fingerprint_tells_null_positions_apart(spark):
    a = spark.createDataFrame([(None, "x")], "p string, q string")
    b = spark.createDataFrame([("x", None)], "p string, q string")
    assert content_fingerprint(a).first() != content_fingerprint(b).first()


def test_orphans_survive_the_loader(spark, scratch):
    from ledgerlake.operators.quality import declared_checks, run_checks
    from ledgerlake.plans.models import Models
    from ledgerlake.sources.crosswalk import RawLayer

    src, folder = "/root/testdata/sf0.001", os.path.join(scratch, "orphans")
    for t in ("orders", "lineitem"):
        spark.read.parquet(f"{src}/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    spark.read.parquet(f"{src}/customer.parquet").where("c_custkey > 20") \
        .write.parquet(f"{folder}/customer.parquet")
    models = Models(RawLayer(spark, folder))
    assert models["stg_accounts"].count() == spark.read.parquet(f"{src}/orders.parquet").count()
    assert models["stg_proposals"].count() == spark.read.parquet(f"{src}/lineitem.parquet").count()
    checks = [c for c in declared_checks() if c.kind == "relationships"]
    found = {r["test_name"]: r["failures"] for r in run_checks(checks, models).collect()}
    assert found["relationships_stg_accounts_client_id__stg_clients_client_id"] > 0
    assert found["relationships_stg_proposals_client_id__stg_clients_client_id"] > 0
