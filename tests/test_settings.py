"""Results do not depend on settings of the session."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module

SETTINGS = {
    "spark.sql.ansi.enabled": "false",
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.session.timeZone": "Asia/Kathmandu",
    "spark.sql.shuffle.partitions": "3",
}
OPERATORS = [
    "region_value_feed",
    "category_counts_top_parts",
    "period_series",
    "histogram_feed",
    "box_summary_events",
    "correlation_matrix",
]


@pytest.mark.parametrize("name", OPERATORS)
def test_other_settings(spark, name):
    def rows():
        frame = entry_module.queries()[name](spark, "/root/testdata/sf0.001")
        return sorted(map(str, frame.collect()))

    usual = rows()
    before = {setting: spark.conf.get(setting) for setting in SETTINGS}
    for setting, value in SETTINGS.items():
        spark.conf.set(setting, value)
    try:
        other = rows()
    finally:
        for setting, value in before.items():
            spark.conf.set(setting, value)
    assert other == usual
