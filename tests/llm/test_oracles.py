"""Every numbered query against its SQL on the test tables."""

import pytest
from oracle_check import compare
from reachlens.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    got = compare(spark, "/root/testdata/sf0.001", [name])[name]
    assert got["columns_match"] and got["types_match"] and got["values_match"], got
    assert got["oracle_rows"] == got["spark_rows"] > 0


def test_queries_without_sql_are_those_that_sql_cannot_say():
    assert set(queries.queries()) - set(queries.oracle_sql()) == {
        "op1_html_text", "op6_quality", "op8_url_filter", "op11_token_files"}
