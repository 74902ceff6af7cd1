import re

import __spark_entry__ as entry


def test_one_query_per_operator():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(bool(re.match(rf"op{n}_", x)) for x in names) == 1
    assert "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
