import datetime as dt

import pytest

from plazaflow.config import EventConfig, scratch_dir


def test_weekday_and_compact_day_follow_from_the_date():
    event = EventConfig()
    assert (event.weekday, event.compact_day) == ("monday", "20260914")
    assert EventConfig(day=dt.date(2026, 7, 25)).weekday == "saturday"


@pytest.mark.parametrize(
    "bad", [{"k_on": "cells"}, {"cell_backend": "square"}, {"hour_weights": (1, 2)}]
)
def test_wrong_settings_are_refused(bad):
    with pytest.raises(ValueError):
        EventConfig(**bad)


def test_scratch_folders_are_below_the_checkpoint_folder_and_never_shared(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two
    if base:
        assert one.startswith(base)
