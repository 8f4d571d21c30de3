"""Best predecessors and link counts against comparing all pairs."""

import random

import pytest

from odflow.operators import links

SCHEMA = "id long, origin long, dest long, p long, d long, value long"


def rows_of(seed, n=400, zones=3, span=4000):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        p = rnd.choice([900, 1200, rnd.randint(-500, span)])
        out.append((i, rnd.randrange(zones), rnd.randrange(zones), p, p + rnd.choice([0, rnd.randint(0, 700)]), rnd.choice([None, rnd.randint(0, 9)])))
    return out


def linked(a, b, gap):
    return a[2] == b[1] and 0 < b[3] - a[4] <= gap


@pytest.mark.parametrize("seed,gap", [(1, 300), (2, 7), (3, 1)])
def test_best_predecessor_and_counts(spark, seed, gap):
    rows = rows_of(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    best, counts = {}, {}
    for b in rows:
        own = [a for a in rows if linked(a, b, gap)]
        top = min(own, key=lambda a: (a[5] is None, -(a[5] or 0), a[3], a[0]), default=None)
        best[b[0]] = (None, None) if top is None else (top[0], top[5])
        counts[b[0]] = (len(own), sum(linked(b, c, gap) for c in rows))
    assert {r["id"]: (r["prev_id"], r["prev_value"]) for r in links.best_predecessor(df, gap).collect()} == best
    assert {r["id"]: (r["predecessors"], r["successors"]) for r in links.link_counts(df, gap).collect()} == counts
    one = links.link_summary(df, gap).first()
    assert one["links"] == sum(c[0] for c in counts.values()) and one["most_successors"] == max(c[1] for c in counts.values())


def test_no_pairs_and_bounded_partitions(spark):
    """20,000 trips of one zone within two gaps have 10**8 links; the plan has no Python and its windows see at most three rows a second."""
    rnd = random.Random(1)
    rows = []
    for i in range(20000):
        p = rnd.randint(0, 600)
        rows.append((i, 0, 0, p, p + rnd.randint(0, 60), 1))
    df = spark.createDataFrame(rows, SCHEMA)
    out = links.link_counts(df, 300)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    ends = [r[4] for r in rows]
    got = {r["id"]: r["predecessors"] for r in out.collect()}
    for r in rows[:50]:
        assert got[r[0]] == sum(0 < r[3] - d <= 300 for d in ends)


def test_folds_run_instead_of_starting_anew_for_every_row(spark):
    """One zone with a trip in every second of two gaps: no window frame reaches to the end of its partition."""
    gap = 500
    rows = [(i, 0, 0, i, i, i % 7) for i in range(2 * gap)]
    df = spark.createDataFrame(rows, SCHEMA)
    best, counts = links.best_predecessor(df, gap), links.link_counts(df, gap)
    for out in (best, counts):
        plan = out._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan
    want = {i: max(range(max(0, i - gap), i), key=lambda a: (a % 7, -a), default=None) for i in range(2 * gap)}
    assert {r["id"]: r["prev_id"] for r in best.collect()} == want
    assert {r["id"]: r["predecessors"] for r in counts.collect()} == {i: min(i, gap) for i in range(2 * gap)}


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert links.best_predecessor(df).collect() == [] and links.link_counts(df).collect() == []
    assert links.link_summary(df).first()["links"] == 0
