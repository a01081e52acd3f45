"""Property tests: Spark operators against plain-Python versions on generated inputs.

Each hypothesis example is a whole list evaluated in one Spark job.
"""

from hypothesis import HealthCheck, given, settings, strategies as st

from mixprep.functions import text as T
from mixprep.operators import stats

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
CHARS = st.sampled_from(list("ab中文。；， \t　 \u001c\n😀x"))
TEXT = st.text(alphabet=CHARS, max_size=80)


def py_summary(c, n=50):
    for sep in ["。", "；", "，", " "]:
        if sep in c:
            return sep.join(c.split(sep)[:3])[:n]
    return c[:n]


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=30))
def test_strip_and_summary_match_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = df.select(T.py_strip("s").alias("a"), T.caption_summary("s").alias("b"), T.char_len("s").alias("c")).collect()
    assert [r.a for r in got] == [t.strip() for t in texts]
    assert [r.b for r in got] == [py_summary(t) for t in texts]
    assert [r.c for r in got] == [len(t) for t in texts]


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 40)), min_size=1, max_size=300))
def test_rank_percentiles_match_sorted_index(spark, rows):
    df = spark.createDataFrame(rows, "g string, v long")
    got = {r.g: (r.p50, r.p90, r.p99) for r in stats.rank_percentiles(df, ["g"], "v").collect()}
    for g in {k for k, _ in rows}:
        vals = sorted(v for k, v in rows if k == g)
        n = len(vals)
        assert got[g] == (vals[int(n * 0.5)], vals[int(n * 0.9)], vals[int(n * 0.99)])
