import random

import pytest

from farestar.llm.scan import running_totals


@pytest.mark.parametrize("ranges", [1, 7])
def test_running_totals_equal_a_loop(spark, ranges):
    pick = random.Random(8)
    rows = [(pick.choice([1, 1, 1, 2, 5]), i // 9, i % 9, pick.randrange(100), pick.randrange(3)) for i in range(400)]
    pick.shuffle(rows)
    df = spark.createDataFrame(rows, "tail int, block long, packet int, n long, w long").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(ranges == 1).lower())
    spark.conf.set("spark.sql.shuffle.partitions", str(max(ranges, 4)))
    try:
        for group in ([], ["tail"]):
            sums, expected = {}, []
            for tail, block, packet, n, w in sorted(rows, key=lambda r: r[1:3]):
                before = sums.setdefault(tail if group else None, [0, 0])
                expected.append((tail, block, packet, n, w, *before))
                before[:] = before[0] + n, before[1] + w
            got = running_totals(df, ["block", "packet"], ["n", "w"], group).collect()
            assert sorted(map(tuple, got)) == sorted(expected)
        assert running_totals(df.limit(0), ["block", "packet"], ["n"]).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_packets_are_dealt_in_order_to_whole_blocks(spark):
    from pyspark.sql import functions as F

    from farestar.llm.wordshuffle import PART_SHIFT, by_block

    for parts, many in ((1, 30), (30, 1), (5, 6)):
        rows = [(p << PART_SHIFT | b, k, n) for p in range(parts) for b in range(many) for k in (0, 1) for n in range(2)]
        table = spark.createDataFrame(rows, "block long, kind int, bucket int").repartition(3)
        found = by_block(table, table, "bucket").withColumn("task", F.spark_partition_id()).collect()
        assert [tuple(r)[:3] for r in found] == sorted(rows)
        tasks = {}
        for r in found:
            tasks.setdefault(r.block, set()).add(r.task)
        assert all(len(t) == 1 for t in tasks.values()) and len({min(t) for t in tasks.values()}) > 1
    assert by_block(table.limit(0), table.limit(0), "bucket").count() == 0
