"""Written tables: who drops them, and what a write leaves behind."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sluice.sources.staging import collecting, handing_up, path_exists, scratch, shuffles_dropped, write_out

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_the_session_keeps_its_setting(spark):
    before = spark.conf.get(CLEANUP)
    with pytest.raises(ZeroDivisionError), shuffles_dropped(spark):
        assert spark.conf.get(CLEANUP) == "true"
        raise ZeroDivisionError
    assert spark.conf.get(CLEANUP) == before


def test_a_frame_can_be_written_twice(spark):
    sums = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n"))
    with scratch(spark):
        first, second = (sorted(map(tuple, write_out(sums, "twice").collect())) for _ in range(2))
    assert first == second == sorted(map(tuple, sums.collect()))


def test_tables_handed_up_outlive_the_block(spark):
    with collecting() as outer:
        with scratch(spark):
            with collecting():  # an owner without tables of its own
                pass
            write_out(spark.range(3), "inner")
            with handing_up():
                kept = write_out(spark.range(5), "kept")
        assert kept.count() == 5
    assert len(outer) == 1 and "/kept-" in outer[0] and path_exists(spark, outer[0])
