"""Every query of this folder that has SQL against it, and the rows of the others, on the given tables."""

import check_queries
import pytest

from foliospark.llm import queries

NO_SQL = {"op2_document_fingerprints", "op3_license_scan", "op5_toxicity", "op6_bpe_encoding", "op8_token_counts", "op10_sharding",
          "op12_quality_rules", "op13_conversation_repair"}


@pytest.fixture(scope="module")
def con(sf):
    return check_queries.connect(sf)


def test_names():
    assert set(queries.QUERIES) == set(queries.ORACLE) | NO_SQL and not NO_SQL & set(queries.ORACLE)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(name, spark, sf, con):
    assert check_queries.compare(queries.QUERIES[name](spark, sf), con, queries.ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(NO_SQL))
def test_a_row_for_each_of_the_table(name, spark, sf, con):
    rows = "SELECT count(DISTINCT conv_id) FROM conversations" if name.startswith("op13") else "SELECT count(*) FROM documents"
    assert queries.QUERIES[name](spark, sf).count() == con.execute(rows).fetchone()[0]
