"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import pytest

from roastery.llm.oracle import ORACLE
from roastery.llm.queries import QUERIES
from tests.compare import connect, difference


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) is None
