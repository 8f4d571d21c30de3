"""Longest chain of linked trips (J1, C1-C10), exact and parallel over time slices.

Contract. Trip b may follow trip a when a ends where b starts and
``0 < start(b) - end(a) <= gap`` whole seconds. ``len(b) = 1 + max len(a)`` over
such a, or 1. The predecessor of b is the a giving the maximum; ties go to the
earliest start, then the smallest id (the order in which a chronological scan
meets them). Every predecessor starts strictly earlier, so lengths do not depend
on the order of equal starts.

Plan, the same at every size:

* Rides. A length depends on a trip's origin and start second only, so trips
  that agree in origin, destination, start and end are one ride (smallest id).
* Slices. Trips are counted per start second; prefix sums over time units of ``UNIT_GAPS`` gaps (one row per unit
  of time) cut slices. A unit with too many trips is cut further at start seconds; a second with too many is dealt by
  hash, as rides that start in one second never link to each other. No slice holds more than ``slice_rows`` rides (a hashed second about that),
  whatever the density. Slices are what the trace back walks.
* Blocks. Consecutive slices make up at most ``MOST_BLOCKS`` + 1 blocks, however many slices there are. A run of blocks is scanned as one
  stream in start order: a task holds one Arrow batch and the best ride per (zone, end second) that is under way or ended within the gap.
* Carry-in. A later block needs of an earlier one, per zone and end second,
  only the best ride ending there, and of those that ended by the block's last start only the ones no later end beats.
* Pass L (no carry-in) and pass R (carry-in = L values, no chain may start in
  the run) scan stretches of ``STRETCH`` blocks. After a few hours of trips nearly all
  lengths differ from the L lengths by one shift per stretch (rank convergence);
  the shifts add up over the stretches as a waiting line does (prefix sums and a running
  minimum over one row per stretch), which gives a guess of every block's carry-in.
* Verify. All blocks run from the guessed carry-in. A block whose carry-in
  equals what the values upstream give is exact by induction from the first one
  (which has none). The others are rerun until nothing changes, in round k as runs of up to 2^k consecutive blocks: a round
  settles the run of the first block that is left, so the loop ends whatever the guess. Values and what a block gives to later
  ones are kept in versions: a round writes the blocks it reran and the carry-in of the blocks these reach, nothing else.
* Trace back. Each pass records for every ride the ride of an earlier slice
  its pointers lead to (its root). Pointer doubling over those cross-slice
  links finds the chain's exit in every slice it visits; each such slice then walks
  its own segment. Nothing chain-long or slice-many is collected.

Every table a call writes belongs to its ``Store`` (``Chain.release``); nothing enters the catalogue, and
session settings stay as they are.
"""

from __future__ import annotations

import heapq
import logging
import sys
from collections import deque
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odflow.functions.columns import pct
from odflow.roles import TripRoles
from odflow.session import shuffle_partitions
from odflow.store import Store, Versions

# Fixed value: the chain rule links trips at most 300 seconds apart.
DEFAULT_GAP_S = 300
#: Rides a slice holds at most, and length of the time unit blocks are made of, in gaps.
SLICE_ROWS, UNIT_GAPS = 200_000, 4
#: Most blocks there are, but for one, and blocks that make up a stretch.
MOST_BLOCKS, STRETCH = 256, 4

log = logging.getLogger(__name__)

# The per-slice functions below run in Python workers; ship their code with the
# tasks so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# --------------------------------------------------------------------------- C1

def _seconds(df: DataFrame, c: Column) -> Column:
    """Whole epoch seconds of a timestamp role, or the role itself if numeric."""
    dtype = df.select(c.alias("x")).schema["x"].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_timestamp(c)
    return F.floor(c).cast("long")


def prepare_trips(df: DataFrame, roles: TripRoles, threshold=None, start_min=None, start_max=None) -> DataFrame:
    """(id, origin, dest, p, d) of the trips the chain may use.

    Keys and times must be non-null, ``distance <= threshold`` if given,
    ``start_min <= start <= start_max`` if given (compared on the raw start
    column, so the range is pushed to the Parquet scan), and ``end >= start``.
    Without an id role ids are assigned in chronological order (``chronological_ids``).
    """
    st, en = roles.col("start"), roles.col("end")
    t = df
    if threshold is not None:
        t = t.where(roles.col("distance") <= F.lit(threshold))
    if start_min is not None:
        t = t.where(st >= F.lit(start_min))
    if start_max is not None:
        t = t.where(st <= F.lit(start_max))
    t = t.where(roles.col("origin").isNotNull() & roles.col("dest").isNotNull() & st.isNotNull() & en.isNotNull())
    out = t.select(
        (roles.col("id").cast("long") if roles.id is not None else F.lit(None).cast("long")).alias("id"),
        roles.col("origin").cast("long").alias("origin"), roles.col("dest").cast("long").alias("dest"),
        _seconds(df, st).alias("p"), _seconds(df, en).alias("d"))
    out = out.where(F.col("p").isNotNull() & F.col("d").isNotNull() & (F.col("d") >= F.col("p")))
    return chronological_ids(out) if roles.id is None else out


def chronological_ids(trips: DataFrame) -> DataFrame:
    """The trips in start order with an id that follows it.

    Range partitioned on the start and sorted within partitions, so no task sorts the whole table; the ids
    grow from partition to partition and inside each. Written once, so that they stay the same for every reader.
    """
    ordered = trips.drop("id").repartitionByRange("p", "origin", "dest", "d").sortWithinPartitions("p", "origin", "dest", "d")
    return Store(trips.sparkSession, "chronological").cut(
        ordered.withColumn("id", F.monotonically_increasing_id()).select("id", "origin", "dest", "p", "d"))


def chain_filter_report(df: DataFrame, roles: TripRoles, threshold=None, start_min=None, start_max=None) -> DataFrame:
    """C1 reports in one aggregate: total, valid (keys, times, distance), in range, removed counts."""
    st, en = roles.col("start"), roles.col("end")
    valid = roles.col("origin").isNotNull() & roles.col("dest").isNotNull() & st.isNotNull() & en.isNotNull()
    if threshold is not None:
        valid = valid & (roles.col("distance") <= F.lit(threshold))
    ps, ds = _seconds(df, st), _seconds(df, en)
    timed = valid & (ds >= ps)
    if start_min is not None:
        timed = timed & (st >= F.lit(start_min))
    if start_max is not None:
        timed = timed & (st <= F.lit(start_max))
    agg = df.agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(F.coalesce(valid, F.lit(False))).alias("valid"),
                 F.count_if(F.coalesce(timed, F.lit(False))).alias("in_range"))
    return agg.select("total", "valid", (F.col("total") - F.col("valid")).alias("removed_invalid"),
                      F.coalesce(pct(F.col("total") - F.col("valid"), F.col("total")), F.lit(0.0))
                      .alias("removed_invalid_pct"),
                      "in_range", (F.col("valid") - F.col("in_range")).alias("removed_time"),
                      F.coalesce(pct(F.col("valid") - F.col("in_range"), F.col("valid")), F.lit(0.0))
                      .alias("removed_time_pct"))


def first_trips(trips: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` trips in start order (ties by id).

    Plans as TakeOrderedAndProject: a top-n per partition, never a global sort.
    """
    return trips.orderBy("p", "id").limit(n).select("id", "origin", "dest", "p", "d")


# --------------------------------------------------------------------------- J1

def predecessor_pairs(trips: DataFrame, gap: int = DEFAULT_GAP_S) -> DataFrame:
    """Every link (prev_id, id, gap_s) with ``prev.dest = origin`` and ``0 < p - prev.d <= gap``.

    A range equi-join: the earlier trip is keyed by (zone, floor(end / gap)), the
    later one is exploded into the two buckets its window can touch, and the
    exact range is a residual predicate. The time bucket in the key spreads a
    busy zone over many join keys; AQE's skew-join split handles a hot bucket.
    """
    a = trips.select(F.col("id").alias("prev_id"), F.col("dest").alias("zone"), F.col("d").alias("prev_d"),
                     F.floor(F.col("d") / gap).cast("long").alias("bucket"))
    lo = F.floor((F.col("p") - gap) / gap).cast("long")
    hi = F.floor((F.col("p") - 1) / gap).cast("long")
    b = trips.select("id", F.col("origin").alias("zone"), "p",
                     F.explode(F.array_distinct(F.array(lo, hi))).alias("bucket"))
    j = b.join(a, ["zone", "bucket"])
    g = F.col("p") - F.col("prev_d")
    return j.where((g > 0) & (g <= gap)).select("prev_id", "id", g.alias("gap_s"))


# ------------------------------------------------------------------ slice scan

class _State:
    """What a scan keeps of the rides it has passed: per zone the candidates that have ended, and per (end second, zone) the best ride
    still under way. An entry is (value, -start, -id, end, slice, root id, root slice), so that the better one is the larger."""

    def __init__(self):
        self.zones: dict = {}
        self.ends: dict = {}
        self.due: list = []  # heap of the seconds in ``ends``

    def add(self, dest: int, entry: tuple) -> None:
        at = self.ends.get(entry[3])
        if at is None:
            self.ends[entry[3]] = {dest: entry}
            heapq.heappush(self.due, entry[3])
        elif dest not in at or at[dest] < entry:
            at[dest] = entry

    def release(self, now: int, gap: int) -> None:
        """Rides that ended before ``now`` become candidates: a deque per zone with the best first; one is kept while no later end is better."""
        while self.due and self.due[0] < now:
            for zone, entry in self.ends.pop(heapq.heappop(self.due)).items():
                dq = self.zones.get(zone)
                if dq is None:
                    dq = self.zones[zone] = deque()
                while dq and dq[-1] < entry:
                    dq.pop()
                while dq and dq[0][3] < now - gap:
                    dq.popleft()
                dq.append(entry)


def _scan(trips: pd.DataFrame, carry: pd.DataFrame, gap: int, allow_start: bool, state: _State | None = None):
    """Chain recurrence over some rides, in start order.

    ``trips``: id, origin, dest, p, d and, if they are of several slices, slice. ``carry``: id, dest, p, d, value, slice
    of earlier trips that may link to them or to later ones. ``state`` is what an earlier call left that scanned the rides before
    these. Returns arrays aligned with ``trips`` rows: value (None = unreachable when chains may not start here),
    prev id, prev slice (the ride's own, -1 without a slice column; -2 = none), and the root: the
    ride of another slice (id, slice) that the trip's pointers inside its slice lead to (None, -1 if the chain starts in its slice).

    A trip becomes a candidate once its end is before the current start. Such
    a trip started before the current one, so it has already been scanned: what the scan holds is the best ride
    per (zone, end second) that has not ended yet or ended within the gap.
    """
    state = state or _State()
    if len(carry):
        c = carry[carry["value"].notna()]
        for v, cp, i, e, z, sl in zip(*(c[k].astype("int64").tolist() for k in ("value", "p", "id", "d", "dest", "slice"))):
            state.add(z, (v, -cp, -i, e, sl, None, -1))
    n = len(trips)
    ids = trips["id"].to_numpy(np.int64)
    ps = trips["p"].to_numpy(np.int64)
    order = np.lexsort((ids, ps)).tolist()
    id_l, p_l = ids.tolist(), ps.tolist()
    org_l, dest_l, d_l = (trips[k].to_numpy(np.int64).tolist() for k in ("origin", "dest", "d"))
    own = trips["slice"].to_numpy(np.int64).tolist() if "slice" in trips else [-1] * n
    val: list = [None] * n
    prev_out: list = [None] * n
    pslice_out = [-2] * n
    root_id: list = [None] * n
    root_sl = [-1] * n
    zones, due = state.zones, state.due
    for i in order:
        pb = p_l[i]
        if due and due[0] < pb:
            state.release(pb, gap)
        dq = zones.get(org_l[i])
        if dq:
            while dq and dq[0][3] < pb - gap:
                dq.popleft()
        if dq:
            best = dq[0]
            val[i] = best[0] + 1
            prev_out[i] = -best[2]
            pslice_out[i] = best[4]
            if best[4] == own[i]:  # predecessor in this slice: inherit its root
                root_id[i], root_sl[i] = best[5], best[6]
            else:
                root_id[i], root_sl[i] = -best[2], best[4]
        elif allow_start:
            val[i] = 1
        else:
            continue
        state.add(dest_l[i], (val[i], -pb, -id_l[i], d_l[i], own[i], root_id[i], root_sl[i]))

    vals = pd.array(val, dtype="Int64")
    prevs = pd.array(prev_out, dtype="Int64")
    return (vals, prevs, np.array(pslice_out, dtype=np.int64),
            pd.array(root_id, dtype="Int64"), np.array(root_sl, dtype=np.int64))


_RIDE = ["id", "origin", "dest", "p", "d", "slice", "front"]
_RIDE_SCHEMA = "id long, origin long, dest long, p long, d long, slice long, front boolean"
_PASS_SCHEMA = "value long, prev_id long, prev_slice long, root_id long, root_slice long"
_CARRY = ["dest", "d", "value", "p", "id", "src"]
#: A slice number is block, step and part in one, so that numbers grow with time from step to step.
_BLOCK, _STEP = 40, 20


def _block(c) -> Column:
    return F.shiftright(c, _BLOCK)


def _stretch(block: Column) -> Column:
    """First block of the stretch a block lies in."""
    return block - F.pmod(block, F.lit(STRETCH))


def _pass_fn(gap: int, allow_start: bool, keep: list[str], frontier_only: bool):
    """Rows by run, each run's carry-in (kind 0) first and its rides in start order -> rides with value, predecessor and root."""

    def run(batches):
        at = state = None
        for batch in batches:
            runs = batch["run"].to_numpy(np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(batch)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if state is None or runs[a] != at:
                    at, state = runs[a], _State()
                rows = batch.iloc[a:b]
                carried = rows["kind"].to_numpy() == 0
                rides = rows[~carried]
                vals, prevs, sources, roots, root_slices = _scan(rides, rows[carried], gap, allow_start, state)
                out = rides[[*_RIDE, *keep]].copy()
                out["value"], out["prev_id"] = vals, prevs
                out["prev_slice"] = np.where(sources == -2, -1, sources)
                out["root_id"], out["root_slice"] = roots, root_slices
                yield out[out["front"].to_numpy(bool)] if frontier_only else out

    return run


@dataclass
class Chain:
    """Lengths of a trip table: ``values`` has one row per ride (id, origin, dest, p, d, slice, value, prev_id,
    prev_slice, root_id, root_slice); the counters tell what the run took."""

    trips: DataFrame
    values: DataFrame
    store: Store
    cells: DataFrame
    rounds: int
    reruns: int

    @property
    def slices(self) -> int:
        return self.cells.agg(F.countDistinct("slice")).first()[0]

    def lengths(self) -> DataFrame:
        """(id, chain_length, prev_id) of every trip."""
        v = self.values.select("origin", "dest", "p", "d", F.col("value").cast("int").alias("chain_length"), "prev_id")
        return self.trips.join(v, ["origin", "dest", "p", "d"]).select("id", "chain_length", "prev_id")

    def release(self) -> None:
        """Remove all files of this call; results not yet read become unusable."""
        self.store.release()


class _Slices:
    """Slices and blocks of a ride table, and the passes over them."""

    def __init__(self, trips: DataFrame, gap: int, slice_rows: int, unit_gaps: float, store: Store):
        self.gap, self.store = gap, store
        self.unit = max(1, int(gap * unit_gaps))
        self.half = max(1, slice_rows // 2)
        self.scratch: list[DataFrame] = []
        seconds = self._cut(trips)
        self.blocks = store.cut(seconds.groupBy("block").agg(F.min("p").alias("lo"), F.max("p").alias("hi")).coalesce(1))
        self.count = self.blocks.count()
        part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
        self.cells = (seconds.groupBy("base", "parts").agg(F.min("p").alias("lo"), F.max("p").alias("hi"))
                      .withColumn("part", part).select((F.col("base") + F.col("part")).alias("slice"), "lo", "hi"))
        rides = trips.groupBy("origin", "dest", "p", "d").agg(F.min("id").alias("id"))
        number = F.col("base") + F.pmod(F.xxhash64("origin", "dest", "p", "d"), F.col("parts"))
        self.rides = store.cut(rides.join(seconds, "p").select(
            "id", "origin", "dest", "p", "d", number.alias("slice"), (F.col("d") + gap > F.col("hi")).alias("front")))

    def _cut(self, trips: DataFrame) -> DataFrame:
        """One row per start second: (p, block, hi: last start of the block, base: number of the slice the second's rides are in,
        parts: slices they are dealt to, 1 unless the second is hot)."""
        half = self.half
        seconds = self.store.cut(trips.groupBy("p").agg(F.count(F.lit(1)).alias("n")).withColumn("unit", F.floor(F.col("p") / self.unit)))
        order = Window.orderBy("unit")
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        units = seconds.groupBy("unit").agg(F.sum("n").alias("n"))
        total = units.agg(F.sum("n")).first()[0] or 0
        block_rows = max(half, -(-total // MOST_BLOCKS))
        # Pieces: consecutive units of at most slice_rows trips, or one dense unit.
        units = units.withColumn("dense", (F.col("n") > half).cast("int")).withColumn("filled", F.coalesce(F.sum("n").over(before), F.lit(0)))
        units = units.withColumn("was", F.lag("dense", 1, 0).over(order))
        units = units.withColumn("run", F.sum(F.col("dense") + F.col("was")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        inside = Window.partitionBy("run").orderBy("unit").rowsBetween(Window.unboundedPreceding, -1)
        units = units.withColumn("fill", F.floor(F.coalesce(F.sum("n").over(inside), F.lit(0)) / half))
        # Blocks: consecutive pieces.
        units = units.withColumn("filled", F.min("filled").over(Window.partitionBy("run", "fill")))
        units = units.withColumn("block", F.dense_rank().over(Window.orderBy(F.floor(F.col("filled") / block_rows))).cast("long") - 1)
        units = self.store.cut(units.select("unit", "block", "run", "fill", "dense"))
        # Steps: a piece, or in a dense unit what the same cut over its seconds gives.
        own = Window.partitionBy("unit").orderBy("p")
        hot = (F.col("n") > half) & (F.col("dense") == 1)
        s = seconds.join(units, "unit").withColumn("hot", hot.cast("int"))
        s = s.withColumn("was", F.lag("hot", 1, 0).over(own))
        s = s.withColumn("turn", F.when(F.col("dense") == 1, F.sum(F.col("hot") + F.col("was")).over(own.rowsBetween(Window.unboundedPreceding, 0))).otherwise(0))
        within = Window.partitionBy("unit", "turn").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
        s = s.withColumn("level", F.when(F.col("dense") == 1, F.floor(F.coalesce(F.sum("n").over(within), F.lit(0)) / half)).otherwise(0))
        step = F.dense_rank().over(Window.partitionBy("block").orderBy("run", "fill", "turn", "level")).cast("long") - 1
        return self.store.cut(s.select(
            "p", "block", F.max("p").over(Window.partitionBy("block")).alias("hi"),
            (F.shiftleft("block", _BLOCK) + F.shiftleft(step, _STEP)).alias("base"),
            F.when(F.col("hot") == 1, F.ceil(F.col("n") / half)).otherwise(1).cast("long").alias("parts")))

    def gives(self, values: DataFrame, value: Column) -> DataFrame:
        """What each block gives to later ones: the best ride per (block, block ``to`` it may link into, zone, end second): largest value, then
        earliest start, then smallest id. Of the rides that ended by the block's last start, one is left out where a better one ended
        later: whatever starts in a later block within the gap of the first starts after the end and within the gap of the second."""
        best = F.max(F.struct(value.alias("value"), (-F.col("p")).alias("p"), (-F.col("id")).alias("id"), F.col("slice").alias("src"))).alias("b")
        one = values.where("front").where(value.isNotNull()).groupBy(_block("slice").alias("block"), "dest", "d").agg(best)
        one = one.join(F.broadcast(self.blocks.select("block", "hi")), "block")
        later = Window.partitionBy("block", "dest").orderBy(F.col("d").desc()).rowsBetween(Window.unboundedPreceding, -1)
        one = one.withColumn("better", F.max(F.when(F.col("d") <= F.col("hi"), F.col("b"))).over(later))
        one = one.where((F.col("d") > F.col("hi")) | F.col("better").isNull() | (F.col("b") > F.col("better"))).drop("hi")
        reach = (F.col("to") > F.col("block")) & (F.col("hi") > F.col("d")) & (F.col("lo") <= F.col("d") + self.gap)
        return one.join(F.broadcast(self.blocks.withColumnRenamed("block", "to")), reach).select(
            "block", "to", "dest", "d", "b.value", (-F.col("b.p")).alias("p"), (-F.col("b.id")).alias("id"), "b.src")

    @staticmethod
    def merged(gives: DataFrame, run: Column) -> DataFrame:
        """Carry-in of each run of blocks: the best of what the blocks before it give."""
        best = F.max(F.struct("value", (-F.col("p")).alias("p"), (-F.col("id")).alias("id"), "src")).alias("b")
        return gives.withColumn("run", run).where("block < run").groupBy("run", "dest", "d").agg(best).select(
            "run", "dest", "d", "b.value", (-F.col("b.p")).alias("p"), (-F.col("b.id")).alias("id"), "b.src")

    def by_block(self, gives: DataFrame) -> DataFrame:
        """Carry-in of each block, under the number of its first slice."""
        return self.merged(gives, F.col("to")).select(F.shiftleft("run", _BLOCK).alias("slice"), *_CARRY)

    def carry(self, values: DataFrame, value: Column) -> DataFrame:
        """Best ride per (later block, zone, end second)."""
        return self.by_block(self.gives(values, value))

    def scan(self, rides: DataFrame, carry: DataFrame | None, runs: int, allow_start: bool = True, keep: tuple[str, ...] = (),
             frontier_only: bool = False) -> DataFrame:
        """One pass: rides with value, predecessor and root. ``rides`` and ``carry`` name in ``run`` the run of blocks they belong to, of which there
        are ``runs``. A task streams a run's rides in start order behind its carry-in."""
        schema = _RIDE_SCHEMA + "".join(f", {k} long" for k in keep) + ", " + _PASS_SCHEMA
        none = F.lit(0).cast("long")
        rows = rides.select("run", F.lit(1).alias("kind"), *_RIDE, *keep, none.alias("value"))
        if carry is not None:
            rows = rows.unionByName(carry.where("value is not null").select(
                "run", F.lit(0).alias("kind"), "id", none.alias("origin"), "dest", "p", "d", F.col("src").alias("slice"),
                F.lit(False).alias("front"), *[none.alias(k) for k in keep], "value"))
        tasks = max(1, min(runs, shuffle_partitions(rides.sparkSession)))
        return rows.repartition(tasks, "run").sortWithinPartitions("run", "kind", "p", "id").mapInPandas(
            _pass_fn(self.gap, allow_start, list(keep), frontier_only), schema)

    def guess(self) -> DataFrame:
        """Carry-in of every block from passes L and R over stretches of blocks and the shifts they show."""
        stretch = _stretch(_block("slice"))
        stretches = -(-self.count // STRETCH)
        low = self.store.cut(self.scan(self.rides.withColumn("run", stretch), None, stretches).select(*_RIDE, F.col("value").alias("lval")))
        given = self.merged(self.gives(low, F.col("lval")), _stretch(F.col("to")))
        high = self.scan(low.withColumn("run", stretch), given, stretches, allow_start=False, keep=("lval",), frontier_only=True)
        high = self.store.cut(high.select(*_RIDE, "lval", F.col("value").alias("rval")).withColumn("run", stretch))
        last = high.where(_block("slice") == F.least(F.col("run") + STRETCH, F.lit(self.count)) - 1)
        counts = last.groupBy("run", (F.col("rval") - F.col("lval")).alias("shift")).agg(F.count(F.lit(1)).alias("n"))
        usual = counts.groupBy("run").agg(F.max_by("shift", F.struct("n", -F.coalesce("shift", F.lit(0)))).alias("shift"))
        # carry(s + 1) = max(0, carry(s) + shift(s)), and 0 where rides of s mostly were not reached.
        order = Window.orderBy("run")
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        usual = usual.withColumn("part", F.coalesce(F.sum(F.col("shift").isNull().cast("int")).over(before), F.lit(0)))
        inside = Window.partitionBy("part").orderBy("run")
        earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
        usual = usual.withColumn("sum", F.sum(F.coalesce("shift", F.lit(0))).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        off = usual.select("run", (F.coalesce(F.sum(F.coalesce("shift", F.lit(0))).over(earlier), F.lit(0))
                                   - F.least(F.lit(0), F.coalesce(F.min("sum").over(earlier), F.lit(0)))).alias("off"))
        guess = F.greatest("lval", F.coalesce(F.col("rval") + F.coalesce("off", F.lit(0)), F.col("lval")))
        self.scratch += [low, high]
        return self.carry(high.join(F.broadcast(off), "run", "left"), guess)

    def tidy(self) -> None:
        """Remove tables that only fed what has been written since."""
        for df in self.scratch:
            self.store.drop(df)
        self.scratch.clear()


def _changed(used: DataFrame, now: DataFrame) -> DataFrame:
    """Blocks whose carry-in differs."""
    key, rest = ["slice", "dest", "d"], ["value", "p", "id", "src"]
    a = used.select(*key, F.struct(*rest).alias("a"))
    b = now.select(*key, F.struct(*rest).alias("b"))
    return a.join(b, key, "full").where(~F.col("a").eqNullSafe(F.col("b"))).select(_block("slice").alias("block")).distinct()


def _runs(blocks: DataFrame, most: int) -> DataFrame:
    """(block, run: first block of its run): consecutive blocks, at most ``most`` in a run."""
    order = Window.orderBy("block")
    place = F.row_number().over(Window.partitionBy("row").orderBy("block")) - 1
    return blocks.select("block", (F.col("block") - F.row_number().over(order)).alias("row")).select(
        "block", (F.col("block") - F.pmod(place, F.lit(most))).alias("run"))


def _of(df: DataFrame, block: Column, blocks: DataFrame) -> DataFrame:
    """Rows whose ``block`` is in ``blocks``, with the other columns of it."""
    return df.join(F.broadcast(blocks.withColumnRenamed("block", "_b")), block == F.col("_b")).drop("_b")


def solve_chain(trips: DataFrame, gap: int = DEFAULT_GAP_S, slice_rows: int = SLICE_ROWS, unit_gaps: float = UNIT_GAPS) -> Chain:
    """Chain values of ``prepare_trips``' table, exact for any slicing; see the module text for the plan.

    Raises ValueError when an id occurs twice.
    """
    spark = trips.sparkSession
    store = Store(spark, "chain")
    try:
        twice = trips.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id").first()
        if twice is not None:
            raise ValueError(f"trip id {twice['id']} occurs more than once")
        parts = _Slices(trips, gap, slice_rows, unit_gaps, store)
        values, gives, used = Versions(store, "block"), Versions(store, "block"), Versions(store, "block")
        with_block, to = _block("slice").alias("block"), F.col("to")
        used.put(parts.guess().select("*", with_block))
        values.put(parts.scan(parts.rides.withColumn("run", with_block), used.latest().withColumn("run", F.col("block")), parts.count).select("*", with_block))
        gives.put(parts.gives(values.latest(), F.col("value")))
        parts.tidy()
        dirty = store.cut(_changed(used.latest(), parts.by_block(gives.latest())))
        rounds = reruns = 0
        while (n := dirty.count()) > 0:  # a number; the blocks stay in Spark
            rounds, reruns = rounds + 1, reruns + n
            runs = store.cut(_runs(dirty, 1 << min(rounds, 20)))
            outside = store.cut(_of(gives.latest(), to, runs).where("block < run"))
            values.put(parts.scan(_of(parts.rides, _block("slice"), runs), parts.merged(outside, F.col("run")), n).select("*", with_block), dirty)
            gives.put(parts.gives(values.part(rounds), F.col("value")), dirty)
            # What the blocks of a run were given: by blocks before the run as it was, inside the run as it is now.
            given = outside.unionByName(_of(gives.part(rounds), to, runs).where("block >= run")).drop("run")
            used.put(parts.by_block(given).select("*", with_block), dirty)
            touched = store.cut(gives.part(rounds).select(to.alias("block")).distinct())
            now = parts.by_block(_of(gives.latest(), to, touched))
            again = store.cut(_changed(_of(used.latest(), F.col("block"), touched), now))
            for done in (dirty, runs, outside, touched):
                store.drop(done)
            dirty = again
        found = values.latest().drop("block") if not rounds else store.cut(values.latest().drop("block"))
    except BaseException:
        store.release()
        raise
    log.info("chain: %d verify rounds, %d block reruns", rounds, reruns)
    return Chain(trips, found, store, parts.cells, rounds, reruns)


def chain_lengths(trips: DataFrame, gap: int = DEFAULT_GAP_S, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(id, chain_length, prev_id) for every trip of ``prepare_trips``."""
    return solve_chain(trips, gap, slice_rows).lengths()


# ------------------------------------------------------------------ C7 - C10

def chain_stats(lengths: DataFrame) -> DataFrame:
    """Trips, longest, mean length, share of the longest chain in all trips (%)."""
    agg = lengths.agg(F.count(F.lit(1)).alias("trips"), F.max("chain_length").alias("longest"),
                      F.try_divide(F.sum(F.col("chain_length").cast("long")).cast("double"),
                                   F.count(F.lit(1)).cast("double")).alias("mean_length"))
    return agg.select("trips", "longest", "mean_length",
                      pct(F.col("longest"), F.col("trips")).alias("longest_pct"))


def _segment_fn():
    """One slice: from each exit back to the first ride of the chain in this slice."""

    def run(vals: pd.DataFrame, exits: pd.DataFrame) -> pd.DataFrame:
        out: list[int] = []
        if len(vals) and len(exits):
            ids = vals["id"].to_numpy(np.int64)
            order = np.argsort(ids)
            ids = ids[order]
            own = (vals["prev_slice"].to_numpy(np.int64) == vals["slice"].to_numpy(np.int64))[order]
            prev = vals["prev_id"].fillna(-1).to_numpy(np.int64)[order]
            for x in exits["t_id"].tolist():
                at = int(np.searchsorted(ids, x))
                while True:
                    out.append(int(ids[at]))
                    if not own[at]:
                        break
                    at = int(np.searchsorted(ids, prev[at]))
        return pd.DataFrame({"id": pd.array(out, dtype="int64")})

    return run


def longest_chain(chain: Chain) -> DataFrame:
    """C7 + C8: ids of the trips of the longest chain.

    The chain ends at the longest trip with the earliest start (then smallest
    id). Cross-slice links are followed by pointer doubling: level k maps a ride to the
    one 2^k hops back, until no link is left.
    """
    values, store = chain.values, chain.store
    spark = values.sparkSession
    end = values.orderBy(F.col("value").desc(), F.col("p"), F.col("id")).select("id", "slice").limit(1)
    end = store.cut(end)
    # Rides that some later slice's pointer lands on, and the end; each pass recorded every ride's root.
    landed = values.where("prev_slice >= 0 and prev_slice <> slice").select(F.col("prev_id").alias("id"))
    nodes = landed.unionByName(end.select("id")).distinct()
    level = store.cut(values.join(nodes, "id", "left_semi").select("id", F.col("root_id").alias("nxt")))
    levels = []
    while not level.where("nxt is not null").isEmpty():
        levels.append(level)
        a, b = level.alias("a"), level.alias("b")
        level = store.cut(a.join(b, F.col("a.nxt") == F.col("b.id"), "left").select("a.id", F.col("b.nxt").alias("nxt")))
    path = end.select("id")
    for level in reversed(levels):
        path = store.cut(path.unionByName(path.join(level, "id").where("nxt is not null").select(F.col("nxt").alias("id"))).distinct())
    exits = values.join(path, "id", "left_semi").select(F.col("slice").alias("t_slice"), F.col("id").alias("t_id"))
    visited = values.join(exits.select(F.col("t_slice").alias("slice")).distinct(), "slice", "left_semi")
    return (visited.select("id", "slice", "prev_id", "prev_slice").groupBy("slice")
            .cogroup(exits.groupBy("t_slice")).applyInPandas(_segment_fn(), "id long"))


def chain_listing(chain: Chain, chain_ids: DataFrame) -> DataFrame:
    """Seq, id, origin, dest, start_s, end_s, start_time, end_time, gap_s, gap_text of the chain.

    seq is the chain length at the trip (the k-th trip of a longest chain has
    length k), and the gap comes from the predecessor's end, so no window over
    the chain is needed. Times are zone-less; gap_text is the gap in seconds, START for the chain's first
    trip, and N/A where a predecessor is missing.
    """
    ch = chain.values.join(chain_ids, "id", "left_semi")
    prev = ch.select(F.col("id").alias("prev_id"), F.col("d").alias("prev_d"))
    gap = F.col("p") - F.col("prev_d")
    text = F.when(F.col("value") == 1, F.lit("START")).otherwise(F.coalesce(gap.cast("string"), F.lit("N/A")))
    return (ch.join(prev, "prev_id", "left")
            .select(F.col("value").cast("int").alias("seq"), "id", "origin", "dest",
                    F.col("p").alias("start_s"), F.col("d").alias("end_s"),
                    F.timestamp_seconds("p").cast("timestamp_ntz").alias("start_time"),
                    F.timestamp_seconds("d").cast("timestamp_ntz").alias("end_time"), gap.alias("gap_s"), text.alias("gap_text")))
