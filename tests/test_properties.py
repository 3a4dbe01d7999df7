"""Property tests (hypothesis) of the two operators with real logic."""

from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.operators import asof_join, select_filings
from daybook.operators.filings import SHARE_CONCEPTS
from daybook.schemas import FACT_ROWS
from test_filings import brute, facts_rows

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

TICKERS = st.sampled_from(["A", "B", None])
KEYS = st.one_of(st.none(), st.integers(0, 60))


@SETTINGS
@given(
    left=st.lists(st.tuples(TICKERS, KEYS), max_size=40),
    right=st.dictionaries(st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 60)),
                          st.one_of(st.none(), st.integers(0, 9)), max_size=15),
    bucketed=st.booleans(),
)
def test_asof_matches_brute_force(spark, left, right, bucketed):
    ldf = spark.createDataFrame([(t, k, i) for i, (t, k) in enumerate(left)], "t string, k int, id int")
    rdf = spark.createDataFrame([(t, k, v) for (t, k), v in right.items()], "t string, rk int, v int")
    out = asof_join(ldf, rdf, by="t", left_on="k", right_on="rk", payload=["v"],
                    bucket=(lambda c: F.floor(c / 7)) if bucketed else None)
    got = {r.id: (r.matched_key, r.v) for r in out.collect()}
    assert len(got) == len(left)
    for i, (t, k) in enumerate(left):
        cands = [(rk, v) for (rt, rk), v in right.items() if t is not None and k is not None
                 and rt == t and rk <= k]
        assert got[i] == (max(cands) if cands else (None, None))


ENTRY = st.fixed_dictionaries({
    "form": st.sampled_from(["10-Q", "10-K", "8-K", "10-Q/A", None]),
    "end": st.sampled_from(["2023-09-30", "2023-12-31", "2024-03-31", "2024-06-30", "2025-01-31",
                            "", None, "2024-3-1", "x"]),
    "filed": st.sampled_from(["2024-01-15", "2024-05-01", "2024-08-01", "", None, "bad"]),
    "val": st.one_of(st.none(), st.integers(0, 10 ** 12), st.sampled_from([2.5, 7.9])),
})
COMPANY = st.dictionaries(st.sampled_from(SHARE_CONCEPTS + ["Other"]), st.lists(ENTRY, max_size=6), max_size=4)


@SETTINGS
@given(companies=st.lists(COMPANY, min_size=1, max_size=6))
def test_filing_selection_matches_restatement(spark, companies):
    rows = []
    for n, concepts in enumerate(companies):
        rows += facts_rows(f"{n:010d}", concepts)
    df = spark.createDataFrame(rows, FACT_ROWS)
    got = {}
    for r in select_filings(df, date(2024, 1, 1), date(2024, 12, 31)).collect():
        got.setdefault(r.cik, []).append((r.date_key, r.shares_outstanding))
    expected = {f"{n:010d}": brute(c, 20240101, 20241231) for n, c in enumerate(companies)}
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in expected.items() if v}
