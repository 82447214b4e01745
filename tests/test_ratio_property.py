"""The Spark ratio rounding equals the oracle's integer formula."""

from decimal import ROUND_HALF_UP, Decimal

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from duka.functions.money import ratio
from duka.oracle.conform import ratio_sql
from duka.sources.literals import literal_table

cents = st.integers(min_value=-10**12, max_value=10**12)


def exact(a: int, b: int, scale: int, times: int):
    if b == 0:
        return None
    q = Decimal(a) * times / Decimal(b)
    return q.quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(cents, cents), min_size=50, max_size=50),
       st.sampled_from([(2, 1), (2, 100), (3, 100), (4, 1)]))
def test_ratio_matches_oracle_and_exact(spark, pairs, spec):
    scale, times = spec
    rows = [(Decimal(a).scaleb(-2), Decimal(b).scaleb(-2)) for a, b in pairs]
    df = literal_table(spark, rows, [("a", "decimal(18,2)"), ("b", "decimal(18,2)")])
    got = [r.r for r in df.select(ratio("a", "b", scale=scale, times=times).alias("r")).collect()]
    con = duckdb.connect()
    values = ", ".join(f"({a}::DECIMAL(18,2), {b}::DECIMAL(18,2))" for a, b in rows)
    sql = f"SELECT {ratio_sql('a', 'b', scale=scale, times=times)} AS r FROM (VALUES {values}) t(a, b)"
    oracle = [r[0] for r in con.execute(sql).fetchall()]
    want = [exact(a, b, scale, times) for a, b in pairs]
    assert got == want
    assert oracle == want
