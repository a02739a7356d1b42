"""Every query of the engine against its DuckDB SQL, on the smallest tables."""

import pytest

from sparquill.plans import registry
from tests.conftest import SMALL

NAMES = sorted(registry.queries())


def rows(columns, data):
    keep = sorted(columns)
    return sorted(repr([r[c] for c in keep]) for r in data)


def test_every_query_has_an_oracle():
    assert set(NAMES) == set(registry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_matches(spark, duck, name):
    df = registry.queries()[name](spark, SMALL)
    cur = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    expected = [dict(zip(names, r, strict=True)) for r in cur.fetchall()]
    assert sorted(df.columns) == sorted(names)
    assert rows(names, df.toArrow().to_pylist()) == rows(names, expected)
