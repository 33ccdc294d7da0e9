"""Hypothesis: for any events, any split into merges gives the state of one ordered pass."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from scenarios import KEYS, expected, frame, main, recon, rows_of

from siltline.operators.state import BEFORE, CHANGE, absorb
from siltline.operators.upsert import survivors, upsert

clock = st.sampled_from(["09:00", "09:30", "10:00", "10:30"])
key = st.tuples(st.just(1), st.sampled_from([1, 2, None]))
mains = st.tuples(
    st.just("main"), clock, st.sampled_from([None, "x", "y"]), st.sampled_from([None, 1, 2]), key,
    st.sampled_from([None, "08:00"]),
)
recons = st.tuples(st.just("recon"), clock, st.sampled_from([True, False, None]), st.sampled_from([None, "08:30"]), key)


@st.composite
def feeds(draw):
    events = []
    for tie, e in enumerate(draw(st.lists(st.one_of(mains, recons), min_size=1, max_size=12))):
        if e[0] == "main":
            events.append(main(e[1], e[2], e[3], e[4], e[5], tie=tie))
        else:
            events.append(recon(e[1], e[2], e[3], e[4], tie=tie))
    return draw(st.permutations(events)), draw(st.integers(0, len(events)))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)
@given(feeds())
def test_split_and_order_do_not_matter(spark, feed):
    events, cut = feed
    want = expected(events)
    assert rows_of(upsert(frame(spark, events), KEYS, hot_rows=3, fold_columns=0)) == want
    assert rows_of(upsert(frame(spark, events), KEYS)) == want
    first = absorb(None, survivors(frame(spark, events[:cut]), KEYS), KEYS).drop(CHANGE, BEFORE)
    assert rows_of(absorb(first, frame(spark, events[cut:]), KEYS)) == want
