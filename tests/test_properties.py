"""Random tables against plain Python."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.operators import joins, quality

FEW = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
KEYS = st.one_of(st.none(), st.sampled_from(["a", "b", "hot"]))
ROWS = st.lists(st.tuples(KEYS, st.integers(0, 2)), max_size=30)


@FEW
@given(first=ROWS, second=ROWS)
def test_row_differences_are_counter_differences(spark, first, second):
    ddl = "k STRING, v INT"
    found = quality.row_differences(
        spark.createDataFrame(first, ddl), spark.createDataFrame(second, ddl)
    ).collect()
    counts = Counter(first)
    counts.subtract(Counter(second))
    assert {(r.k, r.v): r.surplus for r in found} == {k: n for k, n in counts.items() if n}


@FEW
@given(
    left=ROWS,
    right=ROWS,
    how=st.sampled_from(["inner", "left", "right", "full", "left_semi", "left_anti"]),
    share=st.sampled_from([0.05, 0.3, 0.9]),
)
def test_salting_never_changes_a_join(spark, left, right, how, share):
    one = spark.createDataFrame(left, "k STRING, v INT")
    two = spark.createDataFrame(right, "k STRING, w INT")
    salted = joins.salted_join(one, two, "k", how, salts=3, share=share)
    plain = one.join(two, "k", how)
    assert Counter(map(tuple, salted.collect())) == Counter(map(tuple, plain.collect()))


@FEW
@given(rows=ROWS, share=st.sampled_from([0.1, 0.34, 0.5]))
def test_hot_keys_are_those_above_the_share(spark, rows, share):
    frame = spark.createDataFrame(rows, "k STRING, v INT")
    counts = Counter(k for k, _ in rows)
    hot = {k for k, n in counts.items() if n > share * len(rows)}
    assert {r.k for r in joins.hot_keys(frame, "k", share).collect()} == hot
