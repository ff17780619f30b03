"""CSV files with quoted newlines, read by many tasks per file.

Whether a line begins inside a quoted field depends on all quotes before it in
the file. A file is cut into Spark's splits of lines, and

1. each split numbers its lines and counts its own quotes and record ends, for
   both answers to "does the split begin inside quotes?" (one pass, no shuffle;
   written to the shared folder, as splits may be cut otherwise in a second scan);
2. a prefix sum over the splits of each file (one small row per split) gives the
   right answer and the number of records before the split;
3. a line that is a whole record passes through; only lines of records with
   newlines are grouped, by file and record number, so a group is one record,
   wherever split borders lie.

Records are parsed by Spark's own CSV expression. Lines end with ``\\n`` or
``\\r\\n``. Errors, not guesses: a file that ends inside quotes, a quote in the
middle of an unquoted field of a record with newlines, a wrong number of fields.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.sources.scratch import written_once

_LINES = ("path string, block long, value string, line long, inside int, odd int, ended long")


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(path, block, value, odd)``: each line, its split, and whether its quotes are odd in number."""
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        "value", (quotes % 2).alias("odd"))


def has_quoted_newlines(spark: SparkSession, path: str) -> bool:
    """Whether any line holds an odd number of quotes, or a carriage return before its end:
    without one, every line is a record."""
    odd = (F.col("odd") == 1) | F.col("value").rlike("\r(?s:.)")
    return bool(file_lines(spark, path).where(odd).limit(1).count())


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each line of a split: its number, whether it begins inside quotes opened in the
    split, and how many lines before it end outside of those."""
    split, line, inside, ended = None, 0, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        paths, blocks = batch.column(0), batch.column(1).to_numpy()
        odd = batch.column(3).to_numpy()
        files = paths.dictionary_encode().indices.to_numpy()
        borders = np.flatnonzero((np.diff(files) != 0) | (np.diff(blocks) != 0)) + 1
        columns = [np.empty(len(odd), "int64"), np.empty(len(odd), "int32"), np.empty(len(odd), "int64")]
        for a, b in pairwise([0, *borders.tolist(), len(odd)]):
            here = (paths[a].as_py(), int(blocks[a]))
            if here != split:
                split, line, inside, ended = here, 0, 0, 0
            after = (inside + np.cumsum(odd[a:b])) % 2
            outside = np.cumsum(after == 0)
            columns[0][a:b] = line + np.arange(b - a)
            columns[1][a] = inside
            columns[1][a + 1:b] = after[:-1]
            columns[2][a] = ended
            columns[2][a + 1:b] = ended + outside[:-1]
            line, inside, ended = line + b - a, int(after[-1]), ended + int(outside[-1])
        yield pa.RecordBatch.from_arrays(
            [paths, batch.column(1), batch.column(2), pa.array(columns[0]), pa.array(columns[1]),
             pa.array(odd.astype("int32")), pa.array(columns[2])],
            ["path", "block", "value", "line", "inside", "odd", "ended"])


def _split_starts(lines: DataFrame) -> DataFrame:
    """``(path, block, starts_inside, records_before)``, one row per split."""
    per_split = lines.groupBy("path", "block").agg(
        (F.sum("odd") % 2).alias("odd"), F.count(F.lit(1)).alias("lines"),
        F.count_if((F.col("inside") + F.col("odd")) % 2 == 0).alias("ends_outside"))
    in_file = Window.partitionBy("path").orderBy("block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    known = per_split.withColumn(
        "starts_inside", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int"))
    ends = F.when(F.col("starts_inside") == 0, F.col("ends_outside")).otherwise(
        F.col("lines") - F.col("ends_outside"))
    last = F.lead("block").over(in_file).isNull() & ((F.col("starts_inside") + F.col("odd")) % 2 == 1)
    return known.select(
        "path", "block",
        F.when(last, F.raise_error(F.concat(F.col("path"), F.lit(" ends inside a quoted field")))
               .cast("int")).otherwise(F.col("starts_inside")).alias("starts_inside"),
        F.coalesce(F.sum(ends).over(before), F.lit(0)).alias("records_before"))


def csv_texts(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """``(path, record, value)``: the text of every record, numbered from 0 in its file."""
    lines = written_once(file_lines(spark, path).mapInArrow(_numbered, _LINES), "csv-lines")
    placed = lines.join(_split_starts(lines), ["path", "block"])
    inside = (F.col("inside") + F.col("starts_inside")) % 2
    placed = placed.select(
        "path", "block", "line", "value",
        (F.col("records_before") + F.when(F.col("starts_inside") == 0, F.col("ended"))
         .otherwise(F.col("line") - F.col("ended"))).alias("record"),
        ((inside == 0) & (F.col("odd") == 0)).alias("whole"))
    parts = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    joined = (placed.where("not whole").groupBy("path", "record").agg(
        F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value")))
    # with each quoted stretch shrunk to one quote, quotes stand only between separators
    outline = F.regexp_replace("value", '"[^"]*"', '"')
    other = f'[^"\\Q{sep}\\E]'
    no_return = placed.where("whole").select("path", "record", "value").unionByName(
        joined).select(
        "path", "record", F.regexp_replace("value", "\r$", "").alias("value"))
    return no_return.withColumn("value", F.when(
        F.contains("value", F.lit("\n")) & outline.rlike(f'{other}"|"{other}'),
        F.raise_error(F.concat(F.col("path"), F.lit(": a quote inside an unquoted field")))
    ).otherwise(F.col("value")))


def split_csv(spark: SparkSession, path: str, names: list[str], options: dict[str, str], *,
              sep: str = ",", header: bool = True) -> DataFrame:
    """The records of one or several files as text columns ``names``, blank ones left out."""
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    parsed = csv_texts(spark, path, sep).where(F.trim("value") != "").select(
        "path", "record", F.from_csv("value", schema, options).alias("fields"))
    if header:
        fields = [F.col("fields")[n] for n in names]
        same = F.lower(F.to_json(F.array(*fields))) == F.lower(
            F.to_json(F.array(*[F.lit(n) for n in names])))
        parsed = parsed.where(
            F.when(F.col("record") > 0, True).when(same, False).otherwise(F.raise_error(
                F.concat(F.col("path"), F.lit(" has another CSV header"))).cast("boolean")))
    return parsed.select("fields.*")
