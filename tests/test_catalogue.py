import math

import pytest

import __spark_entry__ as entry
from granary import catalogue

from .conftest import DATA


def rows(frame):
    def plain(v):
        if v is None or v != v:
            return "null"
        return round(float(v), 6) if isinstance(v, float) and math.isfinite(v) else str(v)

    return sorted(([plain(v) for v in r] for r in frame[sorted(frame.columns)].values.tolist()), key=str)


@pytest.mark.parametrize("name", catalogue.QUERIES)
def test_query_agrees_with_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DATA).toPandas()
    assert rows(got) == rows(duck.execute(catalogue.ORACLES[name]).df())


def test_entry(spark):
    assert entry.entry(spark).count() == len(catalogue.LINE_RULES)
    assert catalogue.QUERIES.keys() <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()
