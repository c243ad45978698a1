"""Every training-data query against its SQL."""

from __future__ import annotations

import pytest

from tempoframe.llm import registry
from tests.test_entry import compared


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    got, want = compared(spark, name, registry.oracle_sql()[name])
    assert got == want
