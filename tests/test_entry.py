"""Driver contract."""

import re

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"video_id", "comment_id", "final_emotion", "wrs", "ecf"} <= set(df.columns)


def test_every_query_has_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    # the queries of the llm subpackage, where it is there, are tested in tests/llm
    own = {name for name in q if name != "pipeline" and not re.match(r"op\d+_", name)}
    # an eigendecomposition by iteration is not SQL: tests/test_termvectors.py holds it against numpy and brute force
    assert own - set(o) == {"dense_text_nearest_chunk"}
