"""Chain operator: FIXTURES edge rows, and equality with a brute-force recurrence
for random tables under any slicing and row order."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from odflow.operators import chain
from odflow.roles import TripRoles

ROLES = TripRoles(origin="o", dest="d", start="s", end="e", distance=None, amount=None, id="id")
SCHEMA = "id long, o long, d long, s long, e long"


def brute(rows, gap):
    """rows: (id, o, d, s, e) with e >= s. Returns {id: (len, prev)}."""
    rows = sorted(rows, key=lambda r: (r[3], r[0]))
    out = {}
    for b in rows:
        best = None
        for a in rows:
            if a[2] == b[1] and 0 < b[3] - a[4] <= gap:
                key = (-out[a[0]][0], a[3], a[0])
                if best is None or key < best:
                    best = key
        out[b[0]] = (1, None) if best is None else (-best[0] + 1, best[2])
    return out


def solve(spark, rows, gap=300, slices=1, unit_gaps=0.5):
    trips = chain.prepare_trips(spark.createDataFrame(rows, SCHEMA), ROLES)
    return chain.solve_chain(trips, gap, slice_rows=max(1, -(-len(rows) // slices)), unit_gaps=unit_gaps)


def result(solved):
    got = {r["id"]: (r["chain_length"], r["prev_id"]) for r in solved.lengths().collect()}
    solved.release()
    return got


def run(spark, rows, gap=300, slices=1, unit_gaps=0.5):
    return result(solve(spark, rows, gap, slices, unit_gaps))


def test_gap_boundaries(spark):
    rows = [(1, 0, 1, 0, 100), (2, 1, 2, 100, 150),      # gap 0: not linked
            (3, 5, 6, 1000, 1100), (4, 6, 7, 1400, 1500),  # gap 300: linked
            (5, 8, 9, 5000, 5100), (6, 9, 1, 5401, 5500)]  # gap 301: not linked
    got = run(spark, rows)
    assert got[2] == (1, None)
    assert got[4] == (2, 3)
    assert got[6] == (1, None)


def test_end_before_start_dropped_and_zero_length(spark):
    rows = [(1, 3, 3, 100, 100),   # zero-length, same zone: no self link
            (2, 3, 3, 50, 40),     # end before start: dropped
            (3, 3, 4, 200, 300)]   # follows trip 1 (gap 100)
    got = run(spark, rows)
    assert 2 not in got
    assert got[1] == (1, None)
    assert got[3] == (2, 1)


def test_equal_starts_any_order(spark):
    rows = [(1, 0, 1, 0, 10), (2, 0, 1, 0, 20), (3, 1, 2, 30, 40), (4, 1, 2, 30, 35), (5, 2, 0, 50, 60)]
    a = run(spark, rows)
    b = run(spark, list(reversed(rows)))
    assert a == b == brute(rows, 300)
    assert a[3] == (2, 1)  # tie on length: earliest start, then smallest id


def test_nulls_dropped(spark):
    rows = [(1, None, 1, 0, 10), (2, 0, None, 0, 10), (3, 0, 1, None, 10), (4, 0, 1, 0, None), (5, 0, 1, 0, 10)]
    assert set(run(spark, rows)) == {5}


def _random_rows(seed, n, zones, span, maxdur):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        s = rnd.randint(0, span)
        dur = rnd.choice([0, rnd.randint(0, maxdur), rnd.randint(0, 30)])
        rows.append((i * 7 + 3, rnd.randint(0, zones - 1), rnd.randint(0, zones - 1), s, s + dur))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,slices", [(1, 1), (2, 2), (3, 5), (4, 9)])
def test_random_tables_match_brute_force(spark, seed, slices):
    rows = _random_rows(seed, 400, 3, 20000, 900)
    assert run(spark, rows, gap=300, slices=slices) == brute(rows, 300)


def test_long_trip_open_over_whole_slices(spark):
    # a trip that spans several slices and links at its far end
    rows = [(1, 0, 5, 0, 10000)]
    rows += [(10 + i, 1, 1, 100 * i, 100 * i + 50) for i in range(100)]
    rows += [(500, 5, 6, 10100, 10200), (501, 6, 5, 10300, 10400)]
    want = brute(rows, 300)
    got = run(spark, rows, gap=300, slices=6)
    assert got == want and got[501] == (3, 500)


def test_longest_chain_and_listing(spark):
    rows = _random_rows(11, 500, 2, 20000, 600)
    solved = solve(spark, rows, slices=4)
    assert solved.slices >= 4
    want = brute(rows, 300)
    longest = max(v[0] for v in want.values())
    starts = {r[0]: r[3] for r in rows}
    cur = min((i for i, v in want.items() if v[0] == longest), key=lambda i: (starts[i], i))
    path = []
    while cur is not None:
        path.append(cur)
        cur = want[cur][1]
    listing = chain.chain_listing(solved, chain.longest_chain(solved)).orderBy("seq").collect()
    assert [r["id"] for r in listing] == list(reversed(path))
    assert [r["seq"] for r in listing] == list(range(1, longest + 1))
    assert listing[0]["gap_s"] is None and all(0 < r["gap_s"] <= 300 for r in listing[1:])
    assert listing[0]["gap_text"] == "START" and listing[1]["gap_text"] == str(listing[1]["gap_s"])
    assert all((r["start_time"] - datetime(1970, 1, 1)).total_seconds() == r["start_s"] for r in listing)
    stats = chain.chain_stats(solved.lengths()).first()
    assert stats["longest"] == longest and stats["trips"] == len(rows)
    alone = chain.chain_listing(solved, spark.createDataFrame([(path[0],)], "id long")).first()
    assert alone["gap_text"] == "N/A" and alone["gap_s"] is None
    solved.release()


def test_predecessor_pairs_match_brute_force(spark):
    rows = _random_rows(5, 300, 3, 10000, 400)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r["prev_id"], r["id"]) for r in chain.predecessor_pairs(chain.prepare_trips(df, ROLES), 300).collect()}
    want = {(a[0], b[0]) for a in rows for b in rows if a[2] == b[1] and 0 < b[3] - a[4] <= 300}
    assert got == want


def test_empty_table(spark):
    assert run(spark, []) == {}


def _dense_rows(seed, n=1500, zones=3, span=15000):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        s = rnd.randint(0, span)
        rows.append((i, rnd.randint(0, zones - 1), rnd.randint(0, zones - 1), s, s + rnd.randint(0, 200)))
    return rows


def test_dense_chains_cross_slices_exactly(spark):
    rows = _dense_rows(1)
    want = brute(rows, 300)
    assert max(v[0] for v in want.values()) > 100  # chains run through every slice
    solved = solve(spark, rows, slices=6)
    assert solved.slices >= 6
    assert result(solved) == want


def test_verify_loop_repairs_a_bad_guess(spark, monkeypatch):
    rows = _dense_rows(2)
    right = chain._Slices.guess
    monkeypatch.setattr(chain._Slices, "guess", lambda self: self.store.cut(right(self).withColumn("value", F.lit(1).cast("long"))))
    solved = solve(spark, rows, slices=5)
    assert solved.rounds >= 1
    assert len(str(solved.values._jdf.queryExecution().analyzed())) < 2000  # the plan does not grow with the rounds
    assert result(solved) == brute(rows, 300)


def test_more_trips_than_a_slice_within_one_gap(spark):
    """All starts within two gaps, slices far narrower than a gap: rounds, carry-in and exactness."""
    rows = [(i, *r[1:3], 5000 + r[3] // 25, 5000 + r[3] // 25 + (r[4] - r[3]) // 8) for i, r in enumerate(_dense_rows(3, n=2000))]
    solved = solve(spark, rows, slices=10, unit_gaps=0.05)
    assert solved.slices >= 9
    span = max(r[4] for r in rows) - min(r[3] for r in rows) + 1
    parts = chain._Slices(solved.trips, 300, 200, 0.05, solved.store)
    carry = parts.carry(solved.values, F.col("value"))
    assert carry.groupBy("slice").count().agg(F.max("count")).first()[0] <= 3 * span  # zones x seconds
    assert result(solved) == brute(rows, 300)


def test_equal_rides_are_one_and_all_trips_come_back(spark):
    rows = [(i, 0, 1, 10, 20) for i in (9, 3, 5)] + [(20, 1, 2, 30, 40), (21, 1, 2, 30, 40), (22, 1, 0, 30, 40)]
    assert run(spark, rows) == brute(rows, 300)
    assert run(spark, rows)[20] == (2, 3)


def test_duplicate_ids_are_refused(spark):
    rows = [(1, 0, 1, 10, 20), (1, 0, 2, 30, 40)]
    with pytest.raises(ValueError, match="more than once"):
        run(spark, rows)


def test_prepare_with_threshold_and_range(spark):
    df = spark.createDataFrame([(1, 0, 1, 10, 20, 1.0), (2, 0, 1, 10, 20, 9.0), (3, 0, 1, 50, 60, 1.0), (4, 0, 1, 5, 20, None), (5, 0, 1, 30, 40, 2.0)],
                               SCHEMA + ", x double")
    roles = TripRoles(origin="o", dest="d", start="s", end="e", distance="x", amount=None, id="id")
    assert {r["id"] for r in chain.prepare_trips(df, roles, 2.0, 10, 40).collect()} == {1, 5}


def test_generated_ids_follow_the_start(spark):
    rnd = random.Random(4)
    rows = [(None, i % 3, i % 2, rnd.randint(0, 999), 1000) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    roles = TripRoles(origin="o", dest="d", start="s", end="e", distance=None, amount=None, id=None)
    trips = chain.prepare_trips(df, roles)
    got = sorted((r["id"], r["p"]) for r in trips.collect())
    assert [p for _, p in got] == sorted(r[3] for r in rows) and len({i for i, _ in got}) == 300
    assert got == sorted((r["id"], r["p"]) for r in trips.collect())  # stable once written
    assert [r["p"] for r in chain.first_trips(trips, 2).collect()] == [p for _, p in got[:2]]


@pytest.mark.parametrize("seed", range(40))
def test_scan_with_carry_matches_brute_force(seed):
    """Pure-Python check of the per-slice scan: cut a random table at a random
    time; the later part, given the earlier trips with their true values as
    carry-in, must get the true values, predecessors and roots."""
    import pandas as pd

    rnd = random.Random(1000 + seed)
    rows = _random_rows(seed, rnd.randint(1, 250), rnd.randint(1, 4), 6000, rnd.choice([0, 200, 900]))
    gap = rnd.choice([1, 300, 600])
    want = brute(rows, gap)
    cut = rnd.randint(0, 6000)
    early = [r for r in rows if r[3] < cut]
    late = [r for r in rows if r[3] >= cut]
    trips = pd.DataFrame(late, columns=["id", "origin", "dest", "p", "d"])
    carry = pd.DataFrame([(r[0], r[2], r[3], r[4], want[r[0]][0], 0) for r in early],
                         columns=["id", "dest", "p", "d", "value", "slice"])
    if not late:
        return
    vals, prevs, pslices, roots, root_slices = chain._scan(trips, carry, gap, True)
    early_ids = {r[0] for r in early}
    for k, r in enumerate(late):
        length, prev = want[r[0]]
        assert (int(vals[k]), None if pd.isna(prevs[k]) else int(prevs[k])) == (length, prev)
        # root: first pointer that leaves the later part
        cur, root = r[0], None
        while want[cur][1] is not None:
            if want[cur][1] in early_ids:
                root = want[cur][1]
                break
            cur = want[cur][1]
        assert (None if pd.isna(roots[k]) else int(roots[k])) == root
        assert int(root_slices[k]) == (0 if root is not None else -1)
        assert int(pslices[k]) == (-2 if prev is None else (0 if prev in early_ids else -1))


def test_release_removes_all_files_and_the_catalogue_stays_empty(spark):
    import os

    rows = _dense_rows(5, n=600)
    tables = {t.name for t in spark.catalog.listTables()}
    solved = solve(spark, rows, slices=4)
    root = solved.store.root.replace("file:", "")
    assert os.path.isdir(root) and {t.name for t in spark.catalog.listTables()} == tables
    assert result(solved) == brute(rows, 300)
    assert not os.path.exists(root)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_hot_second_and_hot_zone(spark):
    # a third of the trips start in the same second, a third start in zone 0
    rnd = random.Random(9)
    rows = []
    for i in range(1800):
        s = 5000 if i % 3 == 0 else rnd.randint(0, 10000)
        o = 0 if i % 3 == 1 else rnd.randint(1, 3)
        rows.append((i, o, rnd.randint(0, 3), s, s + rnd.randint(0, 250)))
    rnd.shuffle(rows)
    assert run(spark, rows, slices=6) == brute(rows, 300)


def _groups(solved):
    """Rides per group that one Python call gets."""
    return [r["count"] for r in solved.values.groupBy("slice").count().collect()]


def test_no_group_above_the_limit_whatever_the_density(spark):
    """A third of the rides in one second, the rest within a few gaps: all groups stay below slice_rows, lengths and path are exact."""
    rnd = random.Random(21)
    rows = []
    for i in range(1500):
        s = 5000 if i % 3 == 0 else rnd.randint(4300, 6200)
        rows.append((i, rnd.randint(0, 5), rnd.randint(0, 5), s, s + rnd.randint(0, 400)))
    want = brute(rows, 300)
    trips = chain.prepare_trips(spark.createDataFrame(rows, SCHEMA), ROLES)
    solved = chain.solve_chain(trips, 300, slice_rows=240)  # units of four gaps: every unit is dense
    sizes = _groups(solved)
    assert max(sizes) <= 240 and len(sizes) >= 8
    assert solved.values.where("p = 5000").select("slice").distinct().count() >= 3  # the hot second is dealt by hash
    longest = max(v[0] for v in want.values())
    listing = chain.chain_listing(solved, chain.longest_chain(solved)).orderBy("seq").collect()
    assert len(listing) == longest and all(want[r["id"]][0] == r["seq"] for r in listing)
    assert result(solved) == want


def test_a_round_writes_what_it_reran(spark, monkeypatch):
    """A wrong guess for the middle of 200 blocks: the rounds write the blocks they rerun, not the table."""
    rows = [(i, i % 2, (i + 1) % 2, 60 * i, 60 * i + 10) for i in range(400)]  # one chain through all blocks
    right = chain._Slices.guess

    def wrong(self):
        c = right(self)
        late = (F.shiftright("slice", 40) >= 196) & (F.shiftright("slice", 40) < 199)
        return self.store.cut(c.withColumn("value", F.when(late, F.lit(1).cast("long")).otherwise(F.col("value"))))

    monkeypatch.setattr(chain._Slices, "guess", wrong)
    trips = chain.prepare_trips(spark.createDataFrame(rows, SCHEMA), ROLES)
    solved = chain.solve_chain(trips, 300, slice_rows=4, unit_gaps=0.4)
    assert solved.slices == 200 and 1 <= solved.rounds <= 6 and solved.reruns <= 12
    versions = spark.read.parquet(f"{solved.store.root}/*/rows/_v=[1-9]*")  # of values, gives and carry-in
    assert versions.count() <= 40 * solved.reruns
    assert result(solved) == {i: (i + 1, i - 1 if i else None) for i in range(400)}


def test_number_of_blocks_is_bounded_however_small_the_slices(spark, monkeypatch):
    """Slices far narrower than a gap: they share blocks, which are scanned as streams."""
    monkeypatch.setattr(chain, "MOST_BLOCKS", 6, raising=False)
    rows = _dense_rows(6, n=500, span=12000)
    trips = chain.prepare_trips(spark.createDataFrame(rows, SCHEMA), ROLES)
    solved = chain.solve_chain(trips, 300, slice_rows=8, unit_gaps=0.1)
    sizes = _groups(solved)
    assert max(sizes) <= 8 and len(sizes) > 60
    assert solved.values.select(F.shiftright("slice", 40)).distinct().count() <= 7
    assert result(solved) == brute(rows, 300)


def test_runs_of_blocks(spark):
    blocks = spark.createDataFrame([(b,) for b in (9, 3, 4, 5, 6, 7, 12, 13)], "block long")
    got = {r["block"]: r["run"] for r in chain._runs(blocks, 2).collect()}
    assert got == {3: 3, 4: 3, 5: 5, 6: 5, 7: 7, 9: 9, 12: 12, 13: 12}
