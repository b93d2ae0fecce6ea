"""Row numbers of a few wanted rows among all rows in input order, without sorting all rows (op C1).

Input order is cut into blocks: a file's splits (a position made of file, start of the split and place
in it), or ranges of the leading number of a key position. A row's number is the number of rows in the blocks
before its own, from a table of counts by block, plus its place in its own block. Only the
blocks that hold a wanted row are looked into.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import checked_broadcasts

#: Rows of a block of key positions, about. (A block of a file is a split.)
BLOCK_ROWS = 100_000
#: Field of a file position that holds the split's first byte.
SPLIT = "split"


def block_of(rows: DataFrame, pos: str) -> Column:
    """The block of a position, as an orderable value. Blocks of key positions are ranges between the least and
    the largest leading number (three scalars to the driver)."""
    kind = rows.schema[pos].dataType
    fields = kind.names if isinstance(kind, T.StructType) else []
    if SPLIT in fields:
        return F.struct(*(F.col(f"{pos}.{f}").alias(f) for f in fields[:fields.index(SPLIT) + 1]))
    lead = F.col(f"{pos}.{fields[0]}" if fields else pos)
    n, low, high = rows.agg(F.count(lead), F.min(lead), F.max(lead)).first()
    if not n:
        return F.lit(0).cast("long")
    width = (int(high) - int(low)) // max(1, -(-n // BLOCK_ROWS)) + 1
    return F.coalesce(F.floor((lead - F.lit(low)) / F.lit(width)), F.lit(-1)).cast("long")


def row_numbers(rows: DataFrame, wanted: DataFrame, pos: str) -> DataFrame:
    """(``pos``, row_number long, from 1): ``wanted`` positions among those of all ``rows``."""
    at = rows.select(F.col(pos))
    block = block_of(at, pos)
    at = at.withColumn("_block", block)
    before = F.sum("_n").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    # a row for each split or range: a few columns of what the scan had as tasks
    offsets = at.groupBy("_block").agg(F.count(F.lit(1)).alias("_n")) \
        .select("_block", F.coalesce(before, F.lit(0)).alias("_before"))
    # a wanted row's block follows from its position: no pass over the rows
    wanted = wanted.select(pos).distinct().withColumn("_block", block)
    wanted, hits = checked_broadcasts([wanted, wanted.select("_block").distinct()])
    place = F.row_number().over(Window.partitionBy("_block").orderBy(pos))
    near = at.join(hits, "_block", "left_semi").withColumn("_place", place)
    return (near.join(wanted, ["_block", pos]).join(offsets, "_block")
            .groupBy(pos).agg(F.min(F.col("_before") + F.col("_place")).cast("long").alias("row_number")))
