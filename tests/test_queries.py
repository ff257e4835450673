"""Every registered query runs on the smallest tables and agrees with its SQL."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry
from korale.plans import registry
from tests.compare import differences

CORE = registry.queries()


@pytest.mark.parametrize("name", sorted(CORE))
def test_query(spark, sf, name):
    assert differences(spark, sf, [name]) == {}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
