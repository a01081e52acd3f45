"""Fixture views reproduce the row counts stated in FIXTURES.md."""

import os

import pytest

from mixprep.plans import fixtures as fx

COUNTS = {  # view: (sf0.001, sf0.01)
    "item_sid": (200, 2000), "item_caption": (200, 2000), "behaviour": (1000, 10000), "profile": (15, 150),
    "samples": (200, 1000), "alpaca": (16, 98),
}


@pytest.mark.parametrize("sf,idx", [("0.001", 0), ("0.01", 1)])
def test_fixture_row_counts(spark, sf, idx):
    d = f"/root/testdata/sf{sf}"
    if not os.path.isdir(d):
        pytest.skip("driver test data not present")
    for name, counts in COUNTS.items():
        assert getattr(fx, name)(spark, d).count() == counts[idx], name
