"""CSV files whose quoted fields hold newlines, cut into many splits."""

from __future__ import annotations

import csv
import io
import os
import random
from collections import Counter
from contextlib import contextmanager

import pytest

from ledgerlake.operators.quality import csv_records
from ledgerlake.schemas import RAW_SCHEMAS
from ledgerlake.sources import csv_splits
from ledgerlake.sources.readers import csv_texts_table, read_csv_table


@contextmanager
def small_splits(spark):
    """Splits of some dozen bytes while the lines are scanned; the written lines are read as usual."""
    values = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _write(path: str, text: str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def _random_csv(rnd: random.Random, rows: int, end: str) -> tuple[str, list[tuple[str, ...]]]:
    pieces = ["x", "é", ",", '"', "\n", "\n\n", " ", "line", "\\", ";", '""', '",\n"']
    records = [tuple("".join(rnd.choices(pieces, k=rnd.randint(1, 12))) for _ in range(3))
               for _ in range(rows)]
    out = io.StringIO()
    writer = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator=end)
    writer.writerow(["a", "b", "c"])
    writer.writerows(records)
    return out.getvalue(), records


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_random_records_over_many_splits(spark, scratch, end):
    rnd = random.Random(7)
    folder = os.path.join(scratch, f"splits{len(end)}")
    want = Counter()
    for i in range(2):
        text, records = _random_csv(rnd, 60, end)
        _write(os.path.join(folder, f"{i}.csv"), text)
        want.update(records)
    with small_splits(spark):
        lines = csv_splits.file_lines(spark, folder)
        assert lines.select("path", "block").distinct().count() > 30  # borders fall everywhere
        table = csv_texts_table(spark, folder)
    assert Counter(tuple(r) for r in table.collect()) == want
    assert csv_records(spark, folder).first()["csv_rows"] == 120


def test_a_record_over_many_splits_and_empty_fields(spark, scratch):
    long = "\n".join(f"line {i}, \"quoted\"" for i in range(200))
    text = ('cod_cliente,primeiro_nome,ultimo_nome,email,tipo_cliente,data_inclusao,cpfcnpj,'
            'data_nascimento,endereco,cep\n'
            '1,Ana,"",,PF,2020-01-02 03:04:05 UTC,1,1990-05-06,"' + long.replace('"', '""')
            + '",000\n\n2,Bia,,b,PF,2020-01-02 03:04:05 UTC,2,1990-05-06,"C:\\",001')
    path = _write(os.path.join(scratch, "long", "clientes.csv"), text)
    with small_splits(spark):
        table = read_csv_table(spark, path, RAW_SCHEMAS["clientes"])
    rows = {r["cod_cliente"]: r for r in table.collect()}
    assert set(rows) == {1, 2}
    assert rows[1]["endereco"] == long and rows[1]["ultimo_nome"] == "" and rows[1]["email"] is None
    assert rows[2]["endereco"] == "C:\\" and rows[2]["ultimo_nome"] is None


def test_lines_without_newlines_keep_the_plain_scan(spark, scratch):
    path = _write(os.path.join(scratch, "plain", "x.csv"), 'a,b\n1,"x, ""y"""\n2,z\n')
    assert not csv_splits.has_quoted_newlines(spark, path)
    plan = csv_texts_table(spark, path)._jdf.queryExecution().toString()
    assert "FileScan csv" in plan and "MapInArrow" not in plan
    inside = _write(os.path.join(scratch, "return", "x.csv"), 'a,b\n1,"x\ry"\n2,z\n')
    assert sorted(map(tuple, csv_texts_table(spark, inside).collect())) == [("1", "x\ry"), ("2", "z")]


@pytest.mark.parametrize("text,message", [
    ('a,b\n1,"x\ny"\n2,"open\n', "ends inside a quoted field"),
    ('a,b\n1,5" pipe\n2,6" pipe\n3,"x\ny"\n', "quote inside an unquoted field"),
    ('a,b\n1,"x\ny",3\n', "MALFORMED|malformed"),
])
def test_faulty_files_fail(spark, scratch, text, message):
    path = _write(os.path.join(scratch, f"bad{abs(hash(text))}", "x.csv"), text)
    with pytest.raises(Exception, match=message):
        csv_texts_table(spark, path).collect()


def test_headers_must_agree_and_headerless_files(spark, scratch):
    folder = os.path.join(scratch, "headers")
    _write(os.path.join(folder, "1.csv"), 'a,b\n1,"x\ny"\n')
    _write(os.path.join(folder, "2.csv"), 'a,b\n2,z\n')
    assert csv_texts_table(spark, folder).count() == 2
    _write(os.path.join(folder, "3.csv"), 'b,a\n3,w\n')
    with pytest.raises(Exception, match="another CSV header"):
        csv_texts_table(spark, folder).collect()
    bare = _write(os.path.join(scratch, "bare", "x.csv"), '1,"x\ny"\n2,z\n')
    got = csv_texts_table(spark, bare, header=False, names=["p", "q"]).collect()
    assert sorted(map(tuple, got)) == [("1", "x\ny"), ("2", "z")]


def test_only_records_with_newlines_are_grouped(spark, scratch):
    """A file whose quoted field holds a third of all lines: whole lines pass by the grouping."""
    text = "a,b\n" + "".join(f"{i},v\n" for i in range(2000)) + '9,"' + "l\n" * 1000 + '"\n'
    path = _write(os.path.join(scratch, "third", "x.csv"), text)
    df = csv_splits.csv_texts(spark, path)
    assert df.count() == 2002
    assert df.where("value like '9,\"%'").first()["value"].count("\n") == 1000
