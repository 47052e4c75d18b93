"""Registered corpus queries against their SQL on the smallest tables."""

import pytest

from broadsheet.llm.oracles import all_oracles
from broadsheet.llm.queries import all_queries
from oracle_compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(all_oracles()))
def test_query_equals_sql(spark, name):
    assert differences(all_queries()[name](spark, SF_DIR), connect(SF_DIR), all_oracles()[name]) == []
