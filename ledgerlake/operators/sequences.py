"""The row before each row of a sequence, for sequences of any length.

A window function puts all rows of a key into one task, which an account with a
third of all rows doesn't allow. Here rows are dealt into ranges of (key,
order), so a long sequence spans several ranges, and each range is read in
order. The first row of a range gets its predecessor from the end of the
ranges before it: one row per range, whatever the size of the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.sources.scratch import written_once


def _same(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether two columns agree row by row, NULLs being alike."""
    return pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))


def previous_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str],
                  values: dict[str, str], ranges: int | None = None) -> DataFrame:
    """``rows`` with, for each column of ``values`` (column -> new name), the value of the row
    before in its sequence; NULL for the first.

    A sequence is the rows with equal ``keys`` (NULLs are alike) in ``order``,
    NULLs last. Rows that tie in all of ``order`` follow each other in any order.

    Plan: one range exchange, one pass over each range, a written table; then
    the end of each range (a row per range, so its broadcast is bounded by their
    number, ``ranges`` or the session's shuffle partitions) meets the first row
    of the next one that is not empty.
    """
    sorting = [F.asc_nulls_last(c) for c in (*keys, *order)]
    dealt = rows.repartitionByRange(ranges, *sorting) if ranges else \
        rows.repartitionByRange(*sorting)
    placed = dealt.sortWithinPartitions(*sorting).withColumn("_range", F.spark_partition_id())
    names, width = rows.columns, len(rows.columns)
    carried = [*keys, *values]
    schema = T.StructType([*placed.schema.fields, T.StructField("_place", T.LongType()),
                           *(T.StructField(new, rows.schema[c].dataType)
                             for c, new in values.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: dict[str, pa.Array] | None = None
        place = 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            columns = {c: batch.column(names.index(c)) for c in carried}
            ahead = {c: pa.concat_arrays([pa.nulls(1, x.type) if before is None else before[c],
                                          x[:-1]]) for c, x in columns.items()}
            follows = pa.array([place > 0] + [True] * (n - 1))
            for k in keys:
                follows = pc.and_(follows, _same(columns[k], ahead[k]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width + 1], pa.array(range(place, place + n), pa.int64()),
                 *(pc.if_else(follows, ahead[c], pa.nulls(n, ahead[c].type)) for c in values)],
                schema.names)
            before = {c: x[-1:] for c, x in columns.items()}
            place += n

    chained = written_once(placed.mapInArrow(run, schema), "ranges")
    ends = chained.groupBy("_range").agg(
        F.max_by(F.struct(*carried), "_place").alias("_end"))
    ahead = F.lag("_end").over(Window.orderBy("_range"))  # over a row per range
    carry = ends.select("_range", ahead.alias("_end")).withColumn("_place", F.lit(0).cast("long"))
    joined = chained.join(F.broadcast(carry), ["_range", "_place"], "left")
    follows = F.col("_end").isNotNull()
    for k in keys:
        follows = follows & F.col(k).eqNullSafe(F.col(f"_end.{k}"))
    return joined.select(*names, *[
        F.when(follows, F.col(f"_end.{c}")).otherwise(F.col(new)).alias(new)
        for c, new in values.items()])
