"""Source readers: relational tables, CSV extracts and Parquet tables.

Readers always take an explicit schema; nothing is inferred.
"""

from __future__ import annotations

import os
from itertools import pairwise

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.schemas import CSV_TABLES, RAW_KEYS, RAW_SCHEMAS, RELATIONAL_TABLES
from ledgerlake.sources.csv_splits import has_quoted_newlines, split_csv

# The source database schema and the table allow-list (full-table
# replication of the ERP tables; the transactions extract arrives as a file).
SOURCE_SCHEMA = "public"
SOURCE_TABLES = RELATIONAL_TABLES


def jdbc_options(url: str, table: str, *, partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10_000,
                 user: str | None = None, password: str | None = None) -> dict[str, str]:
    """Options of a full-table JDBC scan.

    With a numeric ``partition_column`` and bounds the scan is split into
    ``num_partitions`` range queries that executors run in parallel; without
    them the table is read by a single task, which is only right for small
    tables. Credentials come from the caller (normally the environment),
    never from code.
    """
    opts = {
        "url": url,
        "dbtable": f"{SOURCE_SCHEMA}.{table}",
        "fetchsize": str(fetch_size),
    }
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partitioned JDBC scan needs bounds and num_partitions")
        opts.update({
            "partitionColumn": partition_column,
            "lowerBound": str(lower_bound),
            "upperBound": str(upper_bound),
            "numPartitions": str(num_partitions),
        })
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    return opts


def credentials_from_env(prefix: str = "SOURCE_DB") -> dict[str, str]:
    """``{prefix}_USER`` / ``{prefix}_PASSWORD`` from the environment, if set."""
    out = {}
    for key in ("user", "password"):
        value = os.environ.get(f"{prefix}_{key.upper()}")
        if value is not None:
            out[key] = value
    return out


def key_range_options(spark: SparkSession, url: str, table: str, num_partitions: int,
                      **credentials) -> dict:
    """Even ranges of a table's numeric key, its bounds asked from the source in one query: cheaper
    to ask than :func:`key_ranges`, right for keys without large gaps.

    Empty for one partition, for a table whose first key column isn't a
    number, and for an empty table. Rows outside the bounds (added meanwhile,
    or with a NULL key) still fall into the first or last range.
    """
    column = RAW_KEYS[table][0]
    number = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if num_partitions <= 1 or not isinstance(RAW_SCHEMAS[table][column].dataType, number):
        return {}
    low, high = key_bounds(spark, url, table, column, **credentials)
    if low is None or low == high:
        return {}
    return {"partition_column": column, "lower_bound": int(low), "upper_bound": int(high) + 1,
            "num_partitions": num_partitions}


def key_bounds(spark: SparkSession, url: str, table: str, column: str, **credentials) -> tuple:
    """Smallest and largest value of a column, computed by the source."""
    opts = jdbc_options(url, table, **credentials)
    opts["dbtable"] = (f"(SELECT min({column}) AS low, max({column}) AS high "
                       f"FROM {SOURCE_SCHEMA}.{table}) bounds")
    return tuple(spark.read.format("jdbc").options(**opts).load().first())


def key_ranges(spark: SparkSession, url: str, table: str, num_partitions: int,
               **credentials) -> list[str]:
    """Disjoint predicates on a table's numeric key that cut it into ranges of about equal rows.

    The bounds are quantiles that the source computes in one query, so sparse
    or clustered keys give even ranges, too. Empty (one task reads the table)
    for one partition, for a table whose first key column isn't a number, and
    for an empty table.
    """
    column = RAW_KEYS[table][0]
    number = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if num_partitions <= 1 or not isinstance(RAW_SCHEMAS[table][column].dataType, number):
        return []
    return range_predicates(
        column, key_quantiles(spark, url, table, column, num_partitions, **credentials))


def range_predicates(column: str, bounds: list[int]) -> list[str]:
    """One predicate per range between ``bounds``; every row, also one added below or above them
    meanwhile or with a NULL key, fulfils exactly one. Repeated bounds make no empty range."""
    cuts = sorted(set(bounds))
    if not cuts:
        return []
    if len(cuts) == 1:
        return ["1 = 1"]
    cuts = cuts[1:]  # the lowest value opens the first range, which has no lower end
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in pairwise(cuts)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *middle, f"{column} >= {cuts[-1]}"]


def key_quantiles(spark: SparkSession, url: str, table: str, column: str, parts: int,
                  **credentials) -> list[int]:
    """The lowest key of each of ``parts`` equal shares of the rows, computed by the source."""
    opts = jdbc_options(url, table, **credentials)
    opts["dbtable"] = (
        f"(SELECT min(k) AS low FROM (SELECT {column} AS k, ntile({parts}) OVER (ORDER BY {column}) "
        f"AS part FROM {SOURCE_SCHEMA}.{table} WHERE {column} IS NOT NULL) shares GROUP BY part) bounds")
    return [int(r["low"]) for r in spark.read.format("jdbc").options(**opts).load().collect()]


def read_jdbc_table(spark: SparkSession, url: str, table: str,
                    predicates: list[str] | None = None, **options) -> DataFrame:
    """Full-table scan of one allow-listed source table (S-01, S-02).

    With ``predicates`` (:func:`key_ranges`) each is read by a task of its own.

    The source types are cast to the declared raw schema so the raw layer has
    the same types whatever the driver maps them to.
    """
    if table not in SOURCE_TABLES:
        raise ValueError(f"table {table!r} is not in the source allow-list")
    opts = jdbc_options(url, table, **options)
    if predicates:
        properties = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
        df = spark.read.jdbc(url, opts["dbtable"], predicates=predicates, properties=properties)
    else:
        df = spark.read.format("jdbc").options(**opts).load()
    return conform(df, RAW_SCHEMAS[table])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, cast to the declared types."""
    return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def text_schema(schema: T.StructType) -> T.StructType:
    """The same column names, all text: how an extract is landed before typing."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


#: What a quoted empty field is read as, before it becomes an empty string.
_QUOTED_EMPTY = "\u0001"


def csv_dialect(sep: str = ",") -> dict[str, str]:
    """Options of the database's CSV dialect: fields quoted and quotes doubled with ``"``, no
    backslash escapes, an unquoted empty field NULL, a record with the wrong number of fields
    an error."""
    return {"sep": sep, "mode": "FAILFAST", "quote": '"', "escape": '"', "nullValue": "",
            "emptyValue": _QUOTED_EMPTY}


def csv_reader(spark: SparkSession, *, sep: str = ",", header: bool = True,
               multiline: bool = False) -> DataFrameReader:
    """Spark's reader of that dialect. With ``multiline`` a quoted field may hold newlines, but
    one task reads each file: right for a header, not for data (see :func:`csv_texts_table`)."""
    return (spark.read.options(**csv_dialect(sep)).option("header", header)
            .option("multiLine", multiline)
            .option("enforceSchema", False))  # every file's header must name the same columns


def csv_texts_table(spark: SparkSession, path: str, *, sep: str = ",", header: bool = True,
                    multiline: bool = True, names: list[str] | None = None) -> DataFrame:
    """All records as text columns, each file read by many tasks.

    Spark's CSV scan splits files by lines. ``multiline`` admits newlines in
    quoted fields: the files are searched for a line that isn't a record (one
    pass over the lines, nothing shuffled), and only if there is one does
    :mod:`ledgerlake.sources.csv_splits` find the records. Pass False to save
    that pass for files known to hold none. ``names`` are the columns of files
    without a header.
    """
    schema = None if header else T.StructType([T.StructField(n, T.StringType()) for n in names])
    if not (multiline and has_quoted_newlines(spark, path)):
        reader = csv_reader(spark, sep=sep, header=header)
        return (reader if header else reader.schema(schema)).csv(path)
    if header:
        names = csv_reader(spark, sep=sep, multiline=True).csv(path).columns
    options = csv_dialect(sep) | {"multiLine": "true"}
    return split_csv(spark, path, names, options, sep=sep, header=header)


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType, *,
                   sep: str = ",", header: bool = True, multiline: bool = True) -> DataFrame:
    """Headered CSV with a declared schema (S-03 text extract, S-04 typed load).

    Columns are found by their header names, in any order; a missing one fails
    the load, others are ignored. Fields are parsed as text
    (:func:`csv_texts_table`) and then cast column by column under ANSI rules, so a
    malformed value fails the load instead of becoming NULL, and timestamps
    with a zone suffix (``+00:00``, ``UTC``) are read as instants. An empty
    unquoted field is NULL and a quoted one an empty string, as in a database
    CSV copy. Without a header, columns are taken in the schema's order.
    """
    df = csv_texts_table(spark, path, sep=sep, header=header, multiline=multiline,
                         names=schema.fieldNames())
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return conform(df.select([
        F.when(F.col(f"`{f.name}`") != _QUOTED_EMPTY, F.col(f"`{f.name}`"))
        .when(F.col(f"`{f.name}`") == _QUOTED_EMPTY, F.lit("")).alias(f.name)
        for f in schema.fields]), schema)


def read_raw_csv(spark: SparkSession, folder: str,
                 tables: tuple[str, ...] = RELATIONAL_TABLES + CSV_TABLES,
                 multiline: bool = True) -> dict[str, DataFrame]:
    """Read ``{folder}/{table}.csv`` for each raw table with its declared schema."""
    return {t: read_csv_table(spark, os.path.join(folder, f"{t}.csv"), RAW_SCHEMAS[t],
                              multiline=multiline)
            for t in tables}
