"""Epoch times do not depend on the session's time zone."""

import pytest
from spoor.functions.times import epoch_micros, epoch_millis


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_epoch(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.sql(
            "SELECT TIMESTAMP_NTZ'2024-07-01 12:34:56.123456' AS a, "
            "TIMESTAMP_NTZ'1969-12-31 23:59:59.999' AS b, "
            "timestamp_micros(1719837296123456) AS c"
        )
        row = frame.select(
            epoch_micros(frame, "a"),
            epoch_millis(frame, "a"),
            epoch_millis(frame, "b"),
            epoch_micros(frame, "c"),
            epoch_millis(frame, "c"),
        ).first()
        assert tuple(row) == (
            1719837296123456,
            1719837296123,
            -1,
            1719837296123456,
            1719837296123,
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
