"""Property tests: operator identities on random inputs (few examples each: every
example is a Spark job)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import frame, shot
from shotframe.functions.derive import add_action_group, derive_shots
from shotframe.operators import aggregate as A
from shotframe.schema import ACTION_DEFAULT, ACTION_RULES, DEFAULT_COLUMNS

ZONES = list(DEFAULT_COLUMNS.zones) + ["Backcourt", None]
SETTINGS = settings(max_examples=5, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

row = st.tuples(st.sampled_from(ZONES), st.integers(2000, 2004), st.booleans() | st.none(),
                st.sampled_from(["2PT Field Goal", "3PT Field Goal", None]), st.integers(1, 6))


def _rows(spark, data):
    return derive_shots(frame(spark, [
        shot(GAME_ID=i, BASIC_ZONE=z, SEASON_1=s, SHOT_MADE=m, SHOT_TYPE=t, PLAYER_ID=p)
        for i, (z, s, m, t, p) in enumerate(data)]))


@SETTINGS
@given(st.lists(row, min_size=1, max_size=60))
def test_cells_reaggregate_exactly(spark, data):
    df = _rows(spark, data)
    cells = A.zone_period_cells(df)
    def rows(d):
        return sorted(map(tuple, d.collect()), key=repr)
    assert rows(A.efficiency_from_cells(cells)) == rows(A.efficiency_by(df, "BASIC_ZONE"))
    assert rows(A.rate_from_cells(cells)) == rows(A.rate_by_period(df))


@SETTINGS
@given(st.lists(row, min_size=1, max_size=60))
def test_shares_sum_to_one(spark, data):
    fp = A.share_fingerprint(_rows(spark, data), DEFAULT_COLUMNS, min_attempts=1)
    for r in fp.collect():
        total = sum(r[b + "_share"] for b in DEFAULT_COLUMNS.zones.values())
        assert abs(total - 1.0) < 1e-12
        assert r.total_attempts == sum(r[b + "_cnt"] for b in DEFAULT_COLUMNS.zones.values())


def _bucket(action):
    if action is None:
        return ACTION_DEFAULT
    low = action.lower()
    for name, words in ACTION_RULES:
        if any(w in low for w in words):
            return name
    return ACTION_DEFAULT


fragment = st.sampled_from(["Driving", "DUNK", "layup", "Hook", "jump", "Fade", "pullup", "Pull-Up",
                            "step back", "StepBack", "turnaround", "floating", "tip", "bank", " ",
                            "shot", "x"])


@SETTINGS
@given(st.lists(st.lists(fragment, max_size=4).map("".join) | st.none(), min_size=1, max_size=30))
def test_keyword_buckets_follow_rule_order(spark, actions):
    df = add_action_group(frame(spark, [shot(GAME_ID=i, ACTION_TYPE=a) for i, a in enumerate(actions)]))
    got = {r.GAME_ID: r.ACTION_GROUP for r in df.collect()}
    assert got == {i: _bucket(a) for i, a in enumerate(actions)}
