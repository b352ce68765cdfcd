import __spark_entry__ as entry
from basketry.llm import queries


def test_every_query_is_registered_and_sql_is_text():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert names == list(queries.QUERIES) and [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert all(isinstance(sql, str) for sql in entry.oracle_sql().values())
    assert set(queries.ORACLE) <= set(queries.QUERIES)
