"""Every registered query on the smallest tables: equal to its SQL twin, or rows where SQL has none."""

from __future__ import annotations

import pytest

from secflow.plans import load_all
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
ENTRIES = load_all()
# Model fits are exercised by test_models on small fixtures.
TIMED = {n for n, e in ENTRIES.items() if e.sql is None and e.plan.__module__.endswith((".models", ".selection", ".pipelines"))}


@pytest.mark.parametrize("name", sorted(set(ENTRIES) - TIMED))
def test_query(spark, name):
    assert compare(spark, ENTRIES[name], SF) is None
    spark.catalog.clearCache()
