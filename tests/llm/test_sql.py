"""The registered SQL of the document operators on the smallest given tables."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import digest, duck

from tastemine.llm import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(catalog.ORACLE))
def test_query_equals_its_sql(spark, name):
    df, rel = catalog.QUERIES[name](spark, SF), duck(SF).sql(catalog.ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest([tuple(r) for r in df.collect()], df.columns)[0] == digest(rel.fetchall(), rel.columns)[0]
