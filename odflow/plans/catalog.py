"""Query catalogue: each operator bound to the test tables, with a DuckDB oracle.

Role bindings (the test tables hold no trip table):

* pairs: origin ``l_suppkey % 50 + 1``, dest ``l_partkey % 50 + 1``, distance
  ``l_quantity``, amount ``l_extendedprice``;
* chain: origin ``user_id % 8``, dest ``k % 8`` (k from ``props``), start = whole
  seconds of ``ts``, end = start + floor(``value``) seconds, id ``event_id``;
* profile: lineitem, orders, customer, supplier, events columns.

Every Spark query reads whole tables; every oracle is plain SQL over the same
views. Computed columns carry the same alias on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from odflow.functions.columns import PAYMENT_TYPE_LABELS
from odflow.operators import chain, full_profile, links, outliers, pairs, profile, quantiles, sketches
from odflow.roles import TripRoles
from odflow.sources.parquet import load_trips, schema_report
from odflow.sources.published import publish_result, read_result, retire_versions
from odflow.store import Store

CHAIN_GAP = 300
#: Rides a slice aims at in these queries: few enough that the smallest test table gives several slices.
SLICE_ROWS = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------------ bindings

def pair_roles() -> TripRoles:
    return TripRoles(origin=F.col("l_suppkey") % 50 + 1, dest=F.col("l_partkey") % 50 + 1,
                     start=None, end=None, distance="l_quantity", amount="l_extendedprice")

PAIR_SQL = ("SELECT l_suppkey % 50 + 1 AS origin, l_partkey % 50 + 1 AS dest, "
            "l_quantity AS distance, l_extendedprice AS amount FROM lineitem")

def chain_roles() -> TripRoles:
    return TripRoles(origin=F.col("user_id") % 8,
                     dest=F.regexp_extract("props", r"(\d+)", 1).cast("long") % 8,
                     start=F.col("ts"), end=F.unix_timestamp("ts") + F.floor("value"),
                     distance=None, amount=None, id="event_id")

CHAIN_SQL = ("SELECT event_id AS id, user_id % 8 AS origin, "
             "CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) % 8 AS dest, "
             "epoch_us(ts) // 1000000 AS p, epoch_us(ts) // 1000000 + CAST(floor(value) AS BIGINT) AS d "
             "FROM events WHERE user_id IS NOT NULL AND props IS NOT NULL AND ts IS NOT NULL "
             "AND value IS NOT NULL")

def jump_value():
    return F.col("value") * F.when(F.col("event_id") % 1000 == 0, F.lit(20)).otherwise(F.lit(1))

JUMP_VALUE_SQL = "value * CASE WHEN event_id % 1000 = 0 THEN 20 ELSE 1 END"

NULLED = {"l_returnflag": "R", "l_linestatus": "O"}


def _nulled_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*[F.nullif(F.col(c), F.lit(NULLED[c])).alias(c) if c in NULLED else F.col(c)
                       for c in li.columns])


LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


# ------------------------------------------------------------------ SQL pieces

def _plist(probs) -> str:
    return "[" + ", ".join(repr(float(p)) for p in probs) + "]"


def _elbow_ctes(src: str, x: str, probs=outliers.ELBOW_PROBS) -> str:
    pl = _plist(probs)
    return f"""
vals AS (SELECT unnest(CAST({pl} AS DOUBLE[])) AS p, unnest(quantile_disc({x}, {pl})) AS value FROM {src}),
el AS (SELECT p, value, lag(value) OVER (ORDER BY p) AS prev, lag(p) OVER (ORDER BY p) AS prev_p FROM vals),
tab AS (SELECT p, value, CASE WHEN prev <> 0 THEN value / prev END AS jump,
               coalesce((CASE WHEN prev <> 0 THEN value / prev END) > 2.0 OR (prev = 0 AND value > 0), false)
               AS is_jump, prev, prev_p FROM el),
thr AS (SELECT
  coalesce((SELECT prev * 2.0 FROM tab WHERE is_jump ORDER BY p DESC LIMIT 1),
           (SELECT value FROM tab ORDER BY p DESC LIMIT 1)) AS threshold,
  coalesce((SELECT prev_p FROM tab WHERE is_jump ORDER BY p DESC LIMIT 1),
           (SELECT p FROM tab ORDER BY p DESC LIMIT 1)) AS percentile,
  coalesce((SELECT bool_or(is_jump) FROM tab), false) AS has_jump)"""


def _pair_totals_sql(where: str) -> str:
    return f"""
tot AS (SELECT origin, dest,
  CAST(sum(CAST(amount AS DECIMAL(38,6))) AS DOUBLE) AS total_amount_sum, count(*) AS trip_count,
  CAST(sum(CAST(distance AS DECIMAL(38,6))) AS DOUBLE) / CAST(count(distance) AS DOUBLE) AS avg_distance,
  CAST(sum(CAST(amount AS DECIMAL(38,6))) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_amount
  FROM src WHERE origin IS NOT NULL AND dest IS NOT NULL AND amount IS NOT NULL {where}
  GROUP BY origin, dest)"""


def _neighbour_sql(where: str) -> str:
    return f"""
ps AS (SELECT CAST(origin AS BIGINT) AS origin, CAST(dest AS BIGINT) AS dest,
  sum(CAST(amount AS DECIMAL(38,6))) AS s_amt, count(*) AS trip_count
  FROM src WHERE origin IS NOT NULL AND dest IS NOT NULL AND amount IS NOT NULL {where} GROUP BY 1, 2),
offs AS (SELECT a.i AS di, b.j AS dj FROM range(-1, 2) a(i), range(-1, 2) b(j)),
ex AS (SELECT origin + di AS canonical_origin, dest + dj AS canonical_dest, s_amt, trip_count
       FROM ps, offs WHERE origin + di >= 1 AND dest + dj >= 1),
nt AS (SELECT canonical_origin, canonical_dest, CAST(sum(s_amt) AS DOUBLE) AS total_amount_sum,
       CAST(sum(trip_count) AS BIGINT) AS total_trip_count FROM ex GROUP BY 1, 2)"""


def _chain_sql(gap: int) -> str:
    return f"""WITH RECURSIVE trips AS ({CHAIN_SQL}),
ok AS (SELECT * FROM trips WHERE d >= p),
edges AS (SELECT a.id AS a, b.id AS b FROM ok a JOIN ok b
          ON a.dest = b.origin AND b.p - a.d > 0 AND b.p - a.d <= {gap}),
lens(id, len) AS (SELECT id, 1 FROM ok UNION SELECT e.b, l.len + 1 FROM lens l JOIN edges e ON e.a = l.id),
best AS (SELECT id, max(len) AS chain_length FROM lens GROUP BY id),
cand AS (SELECT e.b AS id, e.a AS prev_id,
                row_number() OVER (PARTITION BY e.b ORDER BY ta.p, e.a) AS rn
         FROM edges e JOIN best bb ON bb.id = e.b JOIN best ba ON ba.id = e.a JOIN ok ta ON ta.id = e.a
         WHERE ba.chain_length = bb.chain_length - 1),
final AS (SELECT t.id, CAST(b.chain_length AS INTEGER) AS chain_length, c.prev_id, t.origin, t.dest, t.p, t.d
          FROM ok t JOIN best b ON b.id = t.id LEFT JOIN cand c ON c.id = t.id AND c.rn = 1)"""


# ------------------------------------------------------------------ queries

def q_top_pairs(spark, sf):
    li = table(spark, sf, "lineitem")
    t = outliers.find_threshold(li, "l_quantity")
    return pairs.top_pairs(li, pair_roles(), threshold=t, n=10)


def q_pair_totals(spark, sf):
    return pairs.pair_totals(table(spark, sf, "lineitem"), pair_roles())


def q_elbow_table(spark, sf):
    return outliers.elbow_table(table(spark, sf, "events"), "value")


def q_elbow_jump(spark, sf):
    return outliers.elbow_table(table(spark, sf, "events"), ("value", jump_value()))


def q_elbow_no_jump(spark, sf):
    return outliers.elbow_threshold(outliers.elbow_table(table(spark, sf, "events"), "value"))


def q_elbow_threshold_jump(spark, sf):
    return outliers.elbow_threshold(outliers.elbow_table(table(spark, sf, "events"), ("value", jump_value())))


def q_removal_report(spark, sf):
    ev = table(spark, sf, "events")
    t = outliers.find_threshold(ev, ("value", jump_value()))
    return outliers.removal_report(ev, jump_value() <= F.lit(t))


def q_null_profile(spark, sf):
    return profile.null_profile(_nulled_lineitem(spark, sf))


def q_distribution(spark, sf):
    return profile.distribution(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


def q_distribution_labelled(spark, sf):
    li = table(spark, sf, "lineitem")
    return profile.distribution(li, ["l_linenumber"], labels=PAYMENT_TYPE_LABELS)


def q_negative_check(spark, sf):
    return profile.negative_check(table(spark, sf, "customer"), ["c_acctbal"])


def q_negative_check_supplier(spark, sf):
    return profile.negative_check(table(spark, sf, "supplier"), ["s_acctbal"])


def q_negative_breakdown(spark, sf):
    return profile.negative_breakdown(table(spark, sf, "customer"), "c_acctbal", "c_mktsegment")


def q_quantile_profile(spark, sf):
    return quantiles.quantile_profile(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity", "l_discount"])


def q_quantile_profile_events(spark, sf):
    return quantiles.quantile_profile(table(spark, sf, "events"), ["value"])


def q_quantile_profile_orders(spark, sf):
    return quantiles.quantile_profile(table(spark, sf, "orders"), ["o_totalprice"])


def q_quantile_approx(spark, sf):
    return quantiles.quantile_profile(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"],
                                      method="approx")


def q_duration_profile(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return profile.duration_profile(j, "o_orderdate", "l_shipdate", unit="days")


def q_period_counts_month(spark, sf):
    return profile.period_counts(table(spark, sf, "orders"), "o_orderdate", "month", expected="1998-09")


def q_period_counts_year(spark, sf):
    return profile.period_counts(table(spark, sf, "orders"), "o_orderdate", "year", expected="1998")


def q_date_range(spark, sf):
    return profile.date_range(table(spark, sf, "orders"), "o_orderdate")


def q_period_split(spark, sf):
    return profile.period_split(table(spark, sf, "orders"), "o_orderdate", "1998-01-01", "1999-01-01")


def q_top_neighbour_pairs(spark, sf):
    li = table(spark, sf, "lineitem")
    t = outliers.find_threshold(li, "l_quantity")
    return pairs.top_neighbour_pairs(li, pair_roles(), threshold=t, n=10)


def q_neighbour_totals(spark, sf):
    return pairs.neighbour_totals(table(spark, sf, "lineitem"), pair_roles())


def q_expansion_stats(spark, sf):
    return pairs.expansion_stats(table(spark, sf, "lineitem"), pair_roles())


def _chain_trips(spark, sf):
    return chain.prepare_trips(table(spark, sf, "events"), chain_roles())


def q_first_trips(spark, sf):
    return chain.first_trips(_chain_trips(spark, sf), 5)


def q_predecessor_pairs(spark, sf):
    return chain.predecessor_pairs(_chain_trips(spark, sf), CHAIN_GAP)


def _solve(spark, sf, gap, **kw):
    return chain.solve_chain(_chain_trips(spark, sf), gap, slice_rows=SLICE_ROWS, **kw)


def q_chain_lengths(spark, sf):
    return _solve(spark, sf, CHAIN_GAP).lengths()


def q_chain_lengths_3600(spark, sf):
    return _solve(spark, sf, 3600).lengths()


def q_chain_stats(spark, sf):
    return chain.chain_stats(_solve(spark, sf, CHAIN_GAP).lengths())


def _listing(solved):
    return chain.chain_listing(solved, chain.longest_chain(solved))


def q_longest_chain(spark, sf):
    return _listing(_solve(spark, sf, CHAIN_GAP))


def q_longest_chain_3600(spark, sf):
    return _listing(_solve(spark, sf, 3600))


# The same with time units of a quarter of a gap: trips reach over several units, and slices are cut closer.
def q_chain_lengths_sliced(spark, sf):
    return _solve(spark, sf, CHAIN_GAP, unit_gaps=0.25).lengths()


def q_longest_chain_3600_sliced(spark, sf):
    return _listing(_solve(spark, sf, 3600, unit_gaps=0.25))


def q_prepared_trips(spark, sf):
    """C1 with the outlier cut and a time range."""
    roles = replace(chain_roles(), distance="value")
    return chain.prepare_trips(table(spark, sf, "events"), roles, 200.0,
                               F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-20 12:00:00").cast("timestamp_ntz"))


def q_chronological_ids(spark, sf):
    """Trips whose generated id follows the start. Neighbours by id are compared within partitions, and the
    partitions (the id's upper bits) by their first and last start: one row each."""
    trips = chain.prepare_trips(table(spark, sf, "events"), replace(chain_roles(), id=None))
    part = F.shiftright("id", 33)
    prev = F.lag("p").over(Window.partitionBy("part").orderBy("id"))
    t = trips.withColumn("part", part).withColumn("back", (F.col("p") < prev).cast("int"))
    ends = t.groupBy("part").agg(F.count("*").alias("n"), F.min("p").alias("first"), F.max("p").alias("last"), F.sum("back").alias("back"))
    over = F.col("first") < F.lag("last").over(Window.orderBy("part"))
    return (ends.withColumn("over", F.coalesce(over.cast("int"), F.lit(0)))
            .agg(F.sum("n").alias("trips"), F.sum(F.coalesce("back", F.lit(0)) + F.col("over")).alias("out_of_order")))


def q_chain_filter_report(spark, sf):
    return chain.chain_filter_report(table(spark, sf, "events"), chain_roles(),
                                     start_min="2024-01-02 00:00:00", start_max="2024-01-29 23:59:59")


def q_union_by_position(spark, sf):
    r = table(spark, sf, "region").select("r_regionkey", "r_name")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return r.union(n)


def q_union_by_name(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("key"))
    r = table(spark, sf, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))
    return n.unionByName(r)


def q_load_by_position(spark, sf):
    return load_trips(spark, sf, "position", names=["region.parquet", "nation.parquet"], width=2)


def q_load_by_name(spark, sf):
    return load_trips(spark, sf, "name", names=["region.parquet", "nation.parquet"])


def q_published_result(spark, sf):
    """Two versions of a result are published; the last one is checked against its manifest and read."""
    path = f"{Store(spark, 'published').root}/orders"
    orders = table(spark, sf, "orders")
    publish_result(orders.filter("o_totalprice < 0"), path)
    publish_result(orders, path)
    retire_versions(spark, path)
    return read_result(spark, path, verify=True)


def q_pair_totals_revenue(spark, sf):
    """A measure with more than two decimals."""
    li = table(spark, sf, "lineitem")
    roles = replace(pair_roles(), amount=F.round(F.col("l_extendedprice") * F.col("l_discount"), 4), distance=F.col("l_quantity") / 8)
    return pairs.pair_totals(li, roles)


def q_distribution_labelled_double(spark, sf):
    """Codes held as doubles."""
    return profile.distribution(table(spark, sf, "lineitem"), ["l_quantity"], labels=PAYMENT_TYPE_LABELS)


def q_distribution_ranked(spark, sf):
    return profile.distribution(table(spark, sf, "lineitem"), ["l_returnflag", "l_linenumber"], ranked=True)


def q_period_counts_ranked(spark, sf):
    return profile.period_counts(table(spark, sf, "orders"), "o_orderdate", "month", ranked=True)


def q_quantile_approx_bounds(spark, sf):
    li = table(spark, sf, "lineitem")
    return quantiles.approx_within_bounds(li, ["l_extendedprice", "l_quantity"], quantiles.PROFILE_PROBS)


def q_trip_profile(spark, sf):
    return profile.profile_table(table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"], ["c_acctbal"])


def _month_sketches(spark, sf):
    """Sketches per ship year of two columns, stored one year group after the other and read back."""
    li = table(spark, sf, "lineitem")
    path = f"{Store(spark, 'sketches').root}/years"
    year = F.year("l_shipdate")
    for group in (0, 1, 2):  # three loads, the last one repeats the second
        some = li.where(F.coalesce(year % 2, F.lit(0)) == (group if group < 2 else 1))
        sketches.add_sketches(sketches.sketch_parts(some, ["l_extendedprice", "l_quantity"], year), path)
    return li, sketches.read_sketches(spark, path)


def q_sketch_parts(spark, sf):
    return _month_sketches(spark, sf)[1].select("part", "column", "n")


def q_sketch_bounds(spark, sf):
    li, kept = _month_sketches(spark, sf)
    return sketches.sketches_within_bounds(li, ["l_extendedprice", "l_quantity"], kept)


def q_full_profile(spark, sf):
    """Every profile section over the events, with the trip's end as ``done``."""
    ev = table(spark, sf, "events").withColumn("done", F.timestamp_seconds(F.unix_timestamp("ts") + F.floor("value")).cast("timestamp_ntz"))
    return full_profile.full_profile(ev.withColumn("change", F.col("value") - 5), ["event_type", "user_id"], ["value", "change"], "ts", "done",
                                     "2024-01", ("change", "event_type"), {"user_id": PAYMENT_TYPE_LABELS})


def q_best_predecessor(spark, sf):
    """J2 with the trip's duration as value."""
    return links.best_predecessor(_chain_trips(spark, sf).withColumn("value", F.col("d") - F.col("p")), 3600)


def q_link_counts(spark, sf):
    return links.link_counts(_chain_trips(spark, sf), 3600)


def q_link_summary(spark, sf):
    return links.link_summary(_chain_trips(spark, sf), CHAIN_GAP)


def q_schema_report(spark, sf):
    return schema_report(table(spark, sf, "lineitem"))


def q_row_count(spark, sf):
    return profile.row_count(table(spark, sf, "lineitem"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "top_pairs": q_top_pairs,
    "pair_totals": q_pair_totals,
    "elbow_table": q_elbow_table,
    "elbow_jump": q_elbow_jump,
    "elbow_no_jump": q_elbow_no_jump,
    "elbow_threshold_jump": q_elbow_threshold_jump,
    "removal_report": q_removal_report,
    "null_profile": q_null_profile,
    "distribution": q_distribution,
    "distribution_labelled": q_distribution_labelled,
    "negative_check": q_negative_check,
    "negative_check_supplier": q_negative_check_supplier,
    "negative_breakdown": q_negative_breakdown,
    "quantile_profile": q_quantile_profile,
    "quantile_profile_events": q_quantile_profile_events,
    "quantile_profile_orders": q_quantile_profile_orders,
    "quantile_approx": q_quantile_approx,
    "duration_profile": q_duration_profile,
    "period_counts_month": q_period_counts_month,
    "period_counts_year": q_period_counts_year,
    "date_range": q_date_range,
    "period_split": q_period_split,
    "top_neighbour_pairs": q_top_neighbour_pairs,
    "neighbour_totals": q_neighbour_totals,
    "expansion_stats": q_expansion_stats,
    "first_trips": q_first_trips,
    "predecessor_pairs": q_predecessor_pairs,
    "chain_lengths": q_chain_lengths,
    "chain_lengths_3600": q_chain_lengths_3600,
    "chain_stats": q_chain_stats,
    "longest_chain": q_longest_chain,
    "longest_chain_3600": q_longest_chain_3600,
    "chain_lengths_sliced": q_chain_lengths_sliced,
    "longest_chain_3600_sliced": q_longest_chain_3600_sliced,
    "chain_filter_report": q_chain_filter_report,
    "prepared_trips": q_prepared_trips,
    "chronological_ids": q_chronological_ids,
    "load_by_position": q_load_by_position,
    "load_by_name": q_load_by_name,
    "published_result": q_published_result,
    "pair_totals_revenue": q_pair_totals_revenue,
    "distribution_labelled_double": q_distribution_labelled_double,
    "distribution_ranked": q_distribution_ranked,
    "period_counts_ranked": q_period_counts_ranked,
    "quantile_approx_bounds": q_quantile_approx_bounds,
    "trip_profile": q_trip_profile,
    "full_profile": q_full_profile,
    "sketch_parts": q_sketch_parts,
    "sketch_bounds": q_sketch_bounds,
    "best_predecessor": q_best_predecessor,
    "link_counts": q_link_counts,
    "link_summary": q_link_summary,
    "union_by_position": q_union_by_position,
    "union_by_name": q_union_by_name,
    "schema_report": q_schema_report,
    "row_count": q_row_count,
}


# ------------------------------------------------------------------ oracles

def _null_profile_sql() -> str:
    cols = []
    for c in LINEITEM_COLS:
        cols.append(f"nullif({c}, '{NULLED[c]}') AS {c}" if c in NULLED else c)
    parts = [f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS null_count,
  coalesce(CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) * 100 / CAST(count(*) AS DOUBLE), 0.0) AS null_pct
  FROM li""" for c in LINEITEM_COLS]
    return f"WITH li AS (SELECT {', '.join(cols)} FROM lineitem)\n" + "\nUNION ALL\n".join(parts)


def _distribution_sql(tbl: str, cols, where: str = "", labels: dict | None = None) -> str:
    u = "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value FROM base""" for c in cols)
    desc = ""
    if labels:
        cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
        desc = (", CASE WHEN value IS NULL THEN NULL ELSE CASE value " + cases +
                " ELSE 'Unknown code (' || value || ')' END END AS description")
    return f"""WITH base AS (SELECT * FROM {tbl} {where}), u AS ({u})
SELECT "column", value, count(*) AS count,
  CAST(count(*) AS DOUBLE) * 100 / CAST((SELECT count(*) FROM base) AS DOUBLE) AS pct{desc}
FROM u GROUP BY "column", value"""


def _negative_sql(tbl: str, c: str) -> str:
    return f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} < 0) AS negative_count,
  coalesce(CAST(count(*) FILTER (WHERE {c} < 0) AS DOUBLE) * 100 / CAST(count(*) AS DOUBLE), 0.0) AS negative_pct,
  CAST(min({c}) AS DOUBLE) AS min, count(*) FILTER (WHERE {c} < 0) > 0 AS issue FROM {tbl}"""


def _qprofile_sql(tbl: str, cols, label_expr=None) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        qs = ", ".join(f"quantile_disc(x, {p}) AS {quantiles.prob_label(p)}" for p in quantiles.PROFILE_PROBS)
        parts.append(f"""SELECT '{c}' AS "column", min(x) AS min, {qs}, max(x) AS max
FROM (SELECT {x} AS x FROM {tbl}) WHERE x IS NOT NULL""")
    return "\nUNION ALL\n".join(parts)


def _duration_sql() -> str:
    qs = ", ".join(f"quantile_disc(x, {p}) AS {quantiles.prob_label(p)}" for p in quantiles.PROFILE_PROBS)
    return f"""WITH j AS (SELECT epoch_us(l_shipdate) // 1000000 - epoch_us(o_orderdate) // 1000000 AS secs
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
x AS (SELECT secs, CAST(secs AS DOUBLE) / 86400.0 AS x FROM j)
SELECT 'duration_days' AS "column", min(x) FILTER (WHERE x IS NOT NULL) AS min, {qs},
  max(x) AS max, CAST(sum(secs) AS DOUBLE) / CAST(count(secs) AS DOUBLE) / 86400.0 AS mean FROM x"""


def _period_sql(fmt: str, expected: str) -> str:
    return f"""SELECT strftime(o_orderdate, '{fmt}') AS period, count(*) AS count,
  CAST(count(*) AS DOUBLE) * 100 / CAST((SELECT count(*) FROM orders) AS DOUBLE) AS pct,
  strftime(o_orderdate, '{fmt}') = '{expected}' AS expected
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1"""


ORACLE: dict[str, str] = {
    "top_pairs": f"""WITH src AS ({PAIR_SQL}), {_elbow_ctes('src', 'distance')}, {_pair_totals_sql(
        "AND distance <= (SELECT threshold FROM thr)")}
SELECT CAST(row_number() OVER (ORDER BY total_amount_sum DESC, origin, dest) AS INTEGER) AS rank,
  origin, dest, total_amount_sum, trip_count, avg_distance, avg_amount FROM tot
ORDER BY total_amount_sum DESC, origin, dest LIMIT 10""",
    "pair_totals": f"""WITH src AS ({PAIR_SQL}), {_pair_totals_sql('')}
SELECT origin, dest, total_amount_sum, trip_count, avg_distance, avg_amount FROM tot""",
    "elbow_table": f"""WITH src AS (SELECT value AS x FROM events), {_elbow_ctes('src', 'x')}
SELECT p, value, jump, is_jump FROM tab""",
    "elbow_jump": f"""WITH src AS (SELECT {JUMP_VALUE_SQL} AS x FROM events), {_elbow_ctes('src', 'x')}
SELECT p, value, jump, is_jump FROM tab""",
    "elbow_no_jump": f"""WITH src AS (SELECT value AS x FROM events), {_elbow_ctes('src', 'x')}
SELECT threshold, percentile, has_jump FROM thr""",
    "elbow_threshold_jump": f"""WITH src AS (SELECT {JUMP_VALUE_SQL} AS x FROM events), {_elbow_ctes('src', 'x')}
SELECT threshold, percentile, has_jump FROM thr""",
    "removal_report": f"""WITH src AS (SELECT {JUMP_VALUE_SQL} AS x FROM events), {_elbow_ctes('src', 'x')}
SELECT count(*) AS total, count(*) FILTER (WHERE x <= (SELECT threshold FROM thr)) AS kept,
  count(*) - count(*) FILTER (WHERE x <= (SELECT threshold FROM thr)) AS removed,
  coalesce(CAST(count(*) - count(*) FILTER (WHERE x <= (SELECT threshold FROM thr)) AS DOUBLE) * 100
           / CAST(count(*) AS DOUBLE), 0.0) AS removed_pct
FROM src""",
    "null_profile": _null_profile_sql(),
    "distribution": _distribution_sql("lineitem", ["l_returnflag", "l_linestatus", "l_linenumber"]),
    "distribution_labelled": _distribution_sql("lineitem", ["l_linenumber"], labels=PAYMENT_TYPE_LABELS),
    "negative_check": _negative_sql("customer", "c_acctbal"),
    "negative_check_supplier": _negative_sql("supplier", "s_acctbal"),
    "negative_breakdown": _distribution_sql("customer", ["c_mktsegment"], where="WHERE c_acctbal < 0"),
    "quantile_profile": _qprofile_sql("lineitem", ["l_extendedprice", "l_quantity", "l_discount"]),
    "quantile_profile_events": _qprofile_sql("events", ["value"]),
    "quantile_profile_orders": _qprofile_sql("orders", ["o_totalprice"]),
    "duration_profile": _duration_sql(),
    "period_counts_month": _period_sql("%Y-%m", "1998-09"),
    "period_counts_year": _period_sql("%Y", "1998"),
    "date_range": "SELECT min(CAST(o_orderdate AS DATE)) AS min_date, max(CAST(o_orderdate AS DATE)) AS max_date "
                  "FROM orders",
    "period_split": """SELECT count(*) AS total,
  count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01') AS in_period,
  coalesce(CAST(count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01')
     AS DOUBLE) * 100 / CAST(count(*) AS DOUBLE), 0.0) AS in_pct,
  count(*) - count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01')
     AS out_period,
  coalesce(CAST(count(*) - count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01'
     AND o_orderdate < TIMESTAMP '1999-01-01') AS DOUBLE) * 100 / CAST(count(*) AS DOUBLE), 0.0) AS out_pct
FROM orders""",
    "top_neighbour_pairs": f"""WITH src AS ({PAIR_SQL}), {_elbow_ctes('src', 'distance')}, {_neighbour_sql(
        "AND distance <= (SELECT threshold FROM thr)")}
SELECT CAST(row_number() OVER (ORDER BY total_amount_sum DESC, canonical_origin, canonical_dest) AS INTEGER) AS rank,
  canonical_origin, canonical_dest, total_amount_sum, total_trip_count FROM nt
ORDER BY total_amount_sum DESC, canonical_origin, canonical_dest LIMIT 10""",
    "neighbour_totals": f"""WITH src AS ({PAIR_SQL}), {_neighbour_sql('')}
SELECT canonical_origin, canonical_dest, total_amount_sum, total_trip_count FROM nt""",
    "expansion_stats": f"""WITH src AS ({PAIR_SQL}), {_neighbour_sql('')}
SELECT (SELECT count(*) FROM ps) AS unique_pairs, (SELECT count(*) FROM ex) AS expanded_rows,
  CAST((SELECT count(*) FROM ex) AS DOUBLE) / CAST((SELECT count(*) FROM ps) AS DOUBLE) AS expansion_ratio""",
    "first_trips": f"""WITH trips AS ({CHAIN_SQL})
SELECT id, origin, dest, p, d FROM trips WHERE d >= p ORDER BY p, id LIMIT 5""",
    "predecessor_pairs": f"""WITH trips AS ({CHAIN_SQL}), ok AS (SELECT * FROM trips WHERE d >= p)
SELECT a.id AS prev_id, b.id AS id, b.p - a.d AS gap_s FROM ok a JOIN ok b
  ON a.dest = b.origin AND b.p - a.d > 0 AND b.p - a.d <= {CHAIN_GAP}""",
    "chain_lengths": _chain_sql(CHAIN_GAP) + "\nSELECT id, chain_length, prev_id FROM final",
    "chain_lengths_3600": _chain_sql(3600) + "\nSELECT id, chain_length, prev_id FROM final",
    "chain_stats": _chain_sql(CHAIN_GAP) + """
SELECT count(*) AS trips, max(chain_length) AS longest,
  CAST(sum(chain_length) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS mean_length,
  CAST(max(chain_length) AS DOUBLE) * 100 / CAST(count(*) AS DOUBLE) AS longest_pct FROM final""",
    "chain_filter_report": f"""WITH t AS ({CHAIN_SQL.replace(
        "WHERE user_id IS NOT NULL AND props IS NOT NULL AND ts IS NOT NULL AND value IS NOT NULL", "")}),
f AS (SELECT count(*) AS total,
  count(*) FILTER (WHERE origin IS NOT NULL AND dest IS NOT NULL AND p IS NOT NULL AND d IS NOT NULL) AS valid,
  count(*) FILTER (WHERE origin IS NOT NULL AND dest IS NOT NULL AND p IS NOT NULL AND d IS NOT NULL AND d >= p
    AND p >= epoch(TIMESTAMP '2024-01-02 00:00:00') AND p <= epoch(TIMESTAMP '2024-01-29 23:59:59')) AS in_range
  FROM t)
SELECT total, valid, total - valid AS removed_invalid,
  coalesce(CAST(total - valid AS DOUBLE) * 100 / CAST(total AS DOUBLE), 0.0) AS removed_invalid_pct,
  in_range, valid - in_range AS removed_time,
  coalesce(CAST(valid - in_range AS DOUBLE) * 100 / CAST(valid AS DOUBLE), 0.0) AS removed_time_pct FROM f""",
    "union_by_position": "SELECT r_regionkey, r_name FROM region UNION ALL SELECT n_nationkey, n_name FROM nation",
    "union_by_name": "SELECT n_name AS name, n_regionkey AS key FROM nation UNION ALL BY NAME "
                     "SELECT r_regionkey AS key, r_name AS name FROM region",
    "row_count": "SELECT count(*) AS rows FROM lineitem",
    "schema_report": """SELECT CAST(ordinal_position AS INTEGER) AS position, column_name AS "column",
  CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'SMALLINT' THEN 'smallint'
    WHEN 'TINYINT' THEN 'tinyint' WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT' THEN 'float'
    WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'DATE' THEN 'date'
    WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp'
    WHEN 'BLOB' THEN 'binary' ELSE lower(data_type) END AS type,
  is_nullable = 'YES' AS nullable
FROM information_schema.columns WHERE table_name = 'lineitem'""",
}

_LINKS = f"""WITH trips AS ({CHAIN_SQL}), ok AS (SELECT * FROM trips WHERE d >= p),
e AS (SELECT a.id AS a, b.id AS b, a.d - a.p AS value, a.p AS ap FROM ok a JOIN ok b ON a.dest = b.origin AND b.p - a.d > 0 AND b.p - a.d <= {{gap}})"""
ORACLE["best_predecessor"] = _LINKS.format(gap=3600) + """
SELECT ok.id, x.a AS prev_id, x.value AS prev_value FROM ok LEFT JOIN
  (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY b ORDER BY value DESC, ap, a) = 1) x ON x.b = ok.id"""
_COUNTS = """,
c AS (SELECT ok.id, coalesce(x.n, 0) AS predecessors, coalesce(y.n, 0) AS successors FROM ok
  LEFT JOIN (SELECT b, count(*) AS n FROM e GROUP BY b) x ON x.b = ok.id LEFT JOIN (SELECT a, count(*) AS n FROM e GROUP BY a) y ON y.a = ok.id)"""
ORACLE["link_counts"] = _LINKS.format(gap=3600) + _COUNTS + " SELECT * FROM c"
ORACLE["link_summary"] = _LINKS.format(gap=CHAIN_GAP) + _COUNTS + """
SELECT CAST(coalesce(sum(predecessors), 0) AS BIGINT) AS links, count(*) FILTER (WHERE predecessors > 0) AS with_predecessor,
  count(*) FILTER (WHERE successors > 0) AS with_successor, max(predecessors) AS most_predecessors, max(successors) AS most_successors FROM c"""
ORACLE["chain_lengths_sliced"] = ORACLE["chain_lengths"]
ORACLE["prepared_trips"] = f"""SELECT * FROM ({CHAIN_SQL} AND value <= 200.0
  AND ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00') WHERE d >= p"""
ORACLE["chronological_ids"] = f"SELECT count(*) AS trips, CAST(0 AS BIGINT) AS out_of_order FROM ({CHAIN_SQL}) WHERE d >= p"
ORACLE["load_by_position"] = ORACLE["union_by_position"]
ORACLE["load_by_name"] = "SELECT * FROM region UNION ALL BY NAME SELECT * FROM nation"
ORACLE["published_result"] = "SELECT * FROM orders"
ORACLE["pair_totals_revenue"] = f"""WITH src AS ({PAIR_SQL.replace('l_quantity AS', 'l_quantity / 8 AS').replace(
    'l_extendedprice AS', 'round(l_extendedprice * l_discount, 4) AS')}), {_pair_totals_sql('')}
SELECT origin, dest, total_amount_sum, trip_count, avg_distance, avg_amount FROM tot"""
ORACLE["distribution_labelled_double"] = _distribution_sql("lineitem", ["l_quantity"]).replace(
    "AS pct", "AS pct, CASE CAST(value AS DOUBLE) " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in PAYMENT_TYPE_LABELS.items())
    + " ELSE 'Unknown code (' || CAST(CAST(CAST(value AS DOUBLE) AS BIGINT) AS VARCHAR) || ')' END AS description")
ORACLE["distribution_ranked"] = f"""SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value) AS INTEGER) AS rank
FROM ({_distribution_sql("lineitem", ["l_returnflag", "l_linenumber"])})"""
ORACLE["period_counts_ranked"] = f"""SELECT period, count, pct, CAST(NULL AS BOOLEAN) AS expected,
  CAST(row_number() OVER (ORDER BY period) AS INTEGER) AS rank FROM ({_period_sql("%Y-%m", "")})"""
ORACLE["quantile_approx_bounds"] = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", CAST({p} AS DOUBLE) AS p, count({c}) > 0 AS within FROM lineitem"""
    for c in ("l_extendedprice", "l_quantity") for p in quantiles.PROFILE_PROBS)
_CUSTOMER = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
ORACLE["trip_profile"] = "\nUNION ALL\n".join(
    [f"""SELECT 'nulls' AS section, '{c}' AS "column", 'null_count' AS item, CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) AS number FROM customer"""
     for c in _CUSTOMER]
    + [f"SELECT 'range', 'c_acctbal', '{n}', CAST({e} AS DOUBLE) FROM customer"
       for n, e in (("min", "min(c_acctbal)"), ("max", "max(c_acctbal)"), ("negative_count", "count(*) FILTER (WHERE c_acctbal < 0)"))]
    + [f"SELECT 'distribution', '{c}', CAST({c} AS VARCHAR), CAST(count(*) AS DOUBLE) FROM customer GROUP BY {c}"
       for c in ("c_nationkey", "c_mktsegment")])

ORACLE["sketch_parts"] = "\nUNION ALL\n".join(
    f"""SELECT CAST(year(l_shipdate) AS VARCHAR) AS part, '{c}' AS "column", count({c}) AS n FROM lineitem GROUP BY 1"""
    for c in ("l_extendedprice", "l_quantity"))
ORACLE["sketch_bounds"] = ORACLE["quantile_approx_bounds"]


def _full_profile_sql() -> str:
    qty = ("value", "change", "duration_minutes")
    rows = "CAST(count(*) AS DOUBLE)"
    no = "CAST(NULL AS DOUBLE)"
    none = "CAST(NULL AS VARCHAR)"

    def fact(section, column, item, number, share=False):
        part = f"100.0 * CAST({number} AS DOUBLE) / {rows}" if share else no
        return f"""SELECT '{section}' AS section, {f"'{column}'" if column else none} AS "column", '{item}' AS item, CAST({number} AS DOUBLE) AS number, {part} AS pct, {none} AS text FROM src"""

    parts = [fact("rows", None, "count", "count(*)")]
    parts += [fact("nulls", c, "null_count", f"count(*) FILTER (WHERE {c} IS NULL)", True)
              for c in ("event_id", "ts", "user_id", "event_type", "value", "props", "done", "change")]
    for c in qty:
        parts += [fact("range", c, "min", f"min({c})"), fact("range", c, "max", f"max({c})"),
                  fact("range", c, "negative_count", f"count(*) FILTER (WHERE {c} < 0)", True)]
    parts.append(fact("range", "duration_minutes", "mean", "CAST(sum(secs) AS DOUBLE) / count(secs) / 60.0"))
    inside = "coalesce(strftime(ts, '%Y-%m') = '2024-01', false)"
    parts += [fact("period", "ts", "in_period", f"count(*) FILTER (WHERE {inside})", True),
              fact("period", "ts", "out_period", f"count(*) FILTER (WHERE NOT {inside})", True)]
    parts += [f"SELECT 'date_range', 'ts', '{n}_date', {no}, {no}, CAST(CAST({n}(ts) AS DATE) AS VARCHAR) FROM src" for n in ("min", "max")]
    label = "CASE item " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PAYMENT_TYPE_LABELS.items()) + " ELSE 'Unknown code (' || item || ')' END"
    expected = "CASE WHEN item = substr('2024-01', 1, length(item)) THEN 'expected' END"

    def groups(section, column, item, text=none, where="true"):
        return (f"SELECT '{section}', '{column}', item, n, 100.0 * n / sum(n) OVER (), {text} FROM "
                f"(SELECT CAST({item} AS VARCHAR) AS item, {rows} AS n FROM src WHERE {where} GROUP BY 1)")

    parts += [groups("distribution", "event_type", "event_type"), groups("negative_by", "event_type", "event_type", where="change < 0"),
              groups("distribution", "user_id", "user_id", f"CASE WHEN item IS NOT NULL THEN {label} END")]
    parts += [f"SELECT * FROM ({groups(s, 'ts', f'strftime(ts, {f!r})', expected)}) WHERE item IS NOT NULL" for s, f in (("month", "%Y-%m"), ("year", "%Y"))]
    parts += [f"SELECT 'quantiles', '{c}', '{quantiles.prob_label(p)}', CAST(quantile_disc({c}, {p}) AS DOUBLE), {no}, {none} FROM src"
              for c in qty for p in quantiles.PROFILE_PROBS]
    return ("WITH ev AS (SELECT *, epoch_us(ts) // 1000000 AS start_s FROM events), src AS (SELECT * EXCLUDE (start_s), start_s + CAST(floor(value) AS BIGINT) AS done, "
            "value - 5 AS change, CAST(floor(value) AS BIGINT) + 0 * start_s AS secs, (CAST(floor(value) AS BIGINT) + 0 * start_s) / 60.0 AS duration_minutes FROM ev)\n"
            + "\nUNION ALL\n".join(parts))


ORACLE["full_profile"] = _full_profile_sql()

for _gap, _key in ((CHAIN_GAP, "longest_chain"), (3600, "longest_chain_3600"),
                   (3600, "longest_chain_3600_sliced")):
    ORACLE[_key] = _chain_sql(_gap) + """,
fin AS (SELECT * FROM final ORDER BY chain_length DESC, p, id LIMIT 1),
walk(id) AS (SELECT id FROM fin UNION ALL
             SELECT f.prev_id FROM walk w JOIN final f ON f.id = w.id WHERE f.prev_id IS NOT NULL)
SELECT f.chain_length AS seq, f.id, f.origin, f.dest, f.p AS start_s, f.d AS end_s,
  make_timestamp(f.p * 1000000) AS start_time, make_timestamp(f.d * 1000000) AS end_time, f.p - pr.d AS gap_s,
  CASE WHEN f.prev_id IS NULL THEN 'START' ELSE coalesce(CAST(f.p - pr.d AS VARCHAR), 'N/A') END AS gap_text
FROM walk w JOIN final f ON f.id = w.id LEFT JOIN final pr ON pr.id = f.prev_id"""
