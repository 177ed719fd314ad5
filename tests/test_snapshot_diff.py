import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marlstone.operators import snapshot_diff as sd

SCHEMA = "snap date, key0 string, a string, b int, at int, leaf string, h1 string"
S = [dt.date(2024, 1, 1) + dt.timedelta(days=14 * i) for i in range(4)]


def build(seed):
    r = random.Random(seed)
    state = {f"k{i}": (r.choice(["x", None, "y"]), i) for i in range(300)}
    rows, states = [], []
    for s in S:
        for k in r.sample(sorted(state), 8):
            del state[k]
        for _ in range(5):
            state[f"n{r.randrange(10**6)}"] = ("new", None)
        for k in r.sample(sorted(state), 6):
            state[k] = (r.choice(["x", "y", None]), r.choice([None, 1]))
        states.append(dict(state))
        for k, (a, b) in state.items():
            rows.append((s, k, a, b, 9, "", ""))
            if r.random() < 0.2:  # repeated and older rows
                rows += [(s, k, a, b, 9, "", ""), (s, k, "old", 0, 1, "", "")]
        rows += [(s, "hot", "h", 1, i, "", "") for i in range(200)]
        rows += [(s, None, "z", 1, 1, "", ""), (None, "k1", "z", 1, 1, "", "")]
    want = set()
    for i in range(1, len(S)):
        old, new = states[i - 1], states[i]
        want |= {(S[i], k, "added") for k in new.keys() - old.keys()} | {(S[i], k, "removed") for k in old.keys() - new.keys()}
        want |= {(S[i], k, "changed") for k in new.keys() & old.keys() if new[k] != old[k]}
    return rows, want


def hashed(spark, rows):
    return sd.normalised(spark.createDataFrame(rows, SCHEMA), F.col("snap"), F.col("key0"), [F.col("a"), F.col("b")], [F.col("at")])


def found(df):
    return {(r.snapshot, r.key, r.change) for r in df.collect()}


def run(spark, rows, depth=None):
    return found(sd.diff(sd.digest(hashed(spark, rows), depth)))


@pytest.mark.parametrize("depth", [5, 15, None])
def test_diff(spark, depth):
    rows, want = build(7)
    assert run(spark, rows, depth) == want


def test_kept_digests_are_added_to(spark):
    rows, want = build(9)
    first = sd.digest(hashed(spark, [r for r in rows if r[0] and r[0] <= S[1]]))
    assert found(sd.diff(first)) == {w for w in want if w[0] <= S[1]}
    both = sd.digest(hashed(spark, [r for r in rows if r[0] and r[0] > S[1]]), earlier=first)
    assert found(sd.diff(both)) == want and found(sd.diff(both, since=S[1])) == {w for w in want if w[0] > S[1]} and found(sd.diff(both, since=S[3])) == set()
    with pytest.raises(ValueError, match="before"):
        sd.digest(hashed(spark, rows), earlier=first)


def test_depth_grows_with_the_keys():
    assert [sd.depth_for(n) for n in (0, 100, 10_000, 10**9)] == [5, 5, 10, 30]


def test_top_down_opens_only_what_differs(spark):
    rows = [(s, f"k{i}", "x", i, 1, "", "") for s in S[:2] for i in range(500)]
    rows[510] = (S[1], rows[510][1], "changed", 1, 1, "", "")
    d = sd.digest(hashed(spark, rows), 10)
    assert sd.differing_leaves(d.trees, 10, d.names).count() == 1


def test_null_is_not_another_value(spark):
    rows = [(S[0], "k", None, 1, 1, "", ""), (S[1], "k", "", 1, 1, "", ""), (S[0], "j", "a", None, 1, "", ""), (S[1], "j", "a", None, 1, "", "")]
    assert run(spark, rows) == {(S[1], "k", "changed")}


def test_empty_and_single(spark):
    assert run(spark, []) == set() and run(spark, [(S[0], "k", "a", 1, 1, "", "")]) == set()
