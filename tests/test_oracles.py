"""Every registered query against its DuckDB oracle at sf0.01."""

import pytest

from conftest import SF01


def _names():
    import __spark_entry__ as e

    return sorted(e.oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, name):
    import __spark_entry__ as e
    from oracle_check import compare

    df = e.queries()[name](spark, SF01)
    ok, a, b, raw = compare(df, e.oracle_sql()[name], SF01)
    if not ok:
        s_cols, s_rows, d_cols, d_rows = raw
        s = sorted(map(repr, s_rows))[:5]
        d = sorted(map(repr, d_rows))[:5]
        pytest.fail(f"{name}: spark {a[:2]} vs duckdb {b[:2]}\nspark: {s}\nduck: {d}")


def test_entry_runs(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
