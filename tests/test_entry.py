"""Driver contract: names, oracle keys and a stable flagship schema."""

import re

import __spark_entry__ as E
from faultline.plans import catalog


def test_names_and_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    for name in q:
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name)
    # names of the document operators are theirs alone
    for name in catalog.QUERIES:
        assert "pipeline" not in name and not re.match(r"op\d+_", name)


def test_entry_schema_is_stable(spark):
    a = E.entry(spark).schema
    b = E.entry(spark).schema
    assert a == b
    assert [f.name for f in a][:3] == ["TAG", "ts_us", "event_id"]
