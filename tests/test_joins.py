from pyspark.sql import functions as F

from smogline.operators import joins as J


def test_broadcast_needs_both_row_and_byte_bounds(spark):
    dim = spark.range(0, 100).select(F.col("id"), F.repeat(F.lit("x"), 1000).alias("text"))
    small, = J.checked_broadcasts([dim])
    assert small is not dim                       # hinted
    by_rows, = J.checked_broadcasts([dim], max_rows=99)
    assert by_rows is dim                         # 100 rows > 99
    by_bytes, = J.checked_broadcasts([dim], max_bytes=100 * 1000)
    assert by_bytes is dim                        # 100 x (8 + 8 + 1000) bytes > 100,000
    ok, over = J.checked_broadcasts([dim.limit(10), dim], max_bytes=50_000)
    assert ok is not dim.limit(10) and over is dim
    fact = spark.range(0, 1000).select((F.col("id") % 100).alias("id"))
    assert J.lookup(fact, dim, "id", how="inner").count() == 1000
