"""Property tests: exact strategies equal Python set counts; admission-based
metrics do not change when input rows are reordered or duplicated."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import BASE_MS
from uvlens.operators.admissions import uv_cumulative, uv_new_visitors
from uvlens.operators.windows import uv_per_window

W = 60_000
events = st.lists(st.tuples(st.integers(0, 40), st.sampled_from(["a", "b", "c"]),
                            st.integers(0, 50 * W)), min_size=1, max_size=120)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=events)
def test_exact_strategies_equal_python(mk, rows):
    df = mk([(u, p, BASE_MS + t) for u, p, t in rows])
    want = {}
    for u, p, t in rows:
        want.setdefault((p, (BASE_MS + t) // W * W + W), set()).add(u)
    want = {k: len(v) for k, v in want.items()}
    for s in ("exact", "dedup", "hash64", "bitmap"):
        got = {(r.page, r.window_time): r.uv for r in uv_per_window(df, W, s).collect()}
        assert got == want, s


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=events)
def test_admissions_ignore_order_and_duplicates(mk, rows):
    ttl = 10 * W
    a = mk([(u, p, BASE_MS + t) for u, p, t in rows])
    b = mk([(u, p, BASE_MS + t) for u, p, t in reversed(rows)] * 2)
    for f in (lambda d: uv_cumulative(d, 30_000, ttl), lambda d: uv_new_visitors(d, W, ttl),
              lambda d: uv_cumulative(d, 30_000), lambda d: uv_new_visitors(d, W)):
        assert sorted(map(tuple, f(a).collect())) == sorted(map(tuple, f(b).collect()))
