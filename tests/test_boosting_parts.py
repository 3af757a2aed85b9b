from pyspark.sql import functions as F

from sparkwright.operators import models as L


def test_boosting_reads_bounded_partitions(spark):
    rows = spark.range(0, 2 * L.PART_ROWS + 1, 1, 1)
    dealt = L._bounded_parts(rows)
    assert dealt.rdd.getNumPartitions() == 3 and dealt.agg(F.sum("id")).first() == rows.agg(F.sum("id")).first()
    assert L._bounded_parts(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == 1
