"""What is written on the way."""

from __future__ import annotations

from relayframe.session import cut_lineage, setting


def test_steps_are_written_with_zstd(spark):
    files = cut_lineage(spark.range(10)).inputFiles()
    assert files and all(".zstd." in name for name in files)


def test_settings_are_put_back(spark):
    key, before = "spark.sql.maxConcurrentOutputFileWriters", spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    spark.conf.set(key, "0")
    try:
        with setting(spark, key):
            assert spark.conf.get(key) == "32"
        assert spark.conf.get(key) == "0"
    finally:
        spark.conf.set(key, before)
