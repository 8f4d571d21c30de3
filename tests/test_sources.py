import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from odflow.sources import list_parquet_files, load_trips, schema_report


def _write(path, cols):
    pq.write_table(pa.table(cols), str(path))


def test_listing_sorted_and_filtered(spark, tmp_path):
    _write(tmp_path / "b.parquet", {"x": [2], "y": ["b"]})
    _write(tmp_path / "a.parquet", {"x": [1], "y": ["a"]})
    (tmp_path / "notes.txt").write_text("ignored")
    files = list_parquet_files(spark, str(tmp_path))
    assert [f.rsplit("/", 1)[1] for f in files] == ["a.parquet", "b.parquet"]


def test_union_by_position_and_by_name(spark, tmp_path):
    _write(tmp_path / "a.parquet", {"x": [1, 2], "y": [10, 20]})
    _write(tmp_path / "b.parquet", {"y": [90], "x": [9]})  # other column order
    by_pos = load_trips(spark, str(tmp_path), merge="position")
    assert by_pos.columns == ["x", "y"]
    assert sorted(tuple(r) for r in by_pos.collect()) == [(1, 10), (2, 20), (90, 9)]
    by_name = load_trips(spark, str(tmp_path), merge="name")
    assert sorted((r["x"], r["y"]) for r in by_name.collect()) == [(1, 10), (2, 20), (9, 90)]


def test_same_layout_files_are_one_scan(spark, tmp_path):
    for i in range(5):
        _write(tmp_path / f"f{i}.parquet", {"x": [i], "y": [str(i)]})
    df = load_trips(spark, str(tmp_path))
    assert df.count() == 5
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan


def test_path_errors(spark, tmp_path):
    with pytest.raises(ValueError):
        load_trips(spark, "")
    with pytest.raises(ValueError):
        load_trips(spark, str(tmp_path / "missing"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError):
        load_trips(spark, str(tmp_path / "empty"))


def test_schema_report(spark):
    df = spark.createDataFrame([(1, "a")], "x long, y string")
    rows = [tuple(r) for r in schema_report(df).collect()]
    assert rows == [(1, "x", "bigint", True), (2, "y", "string", True)]


def test_layouts_grouped_across_the_listing(spark, tmp_path):
    # a, c share a layout; b has its columns the other way round
    _write(tmp_path / "a.parquet", {"x": [1], "y": [10]})
    _write(tmp_path / "b.parquet", {"y": [90], "x": [9]})
    _write(tmp_path / "c.parquet", {"x": [3], "y": [30]})
    from odflow.sources.parquet import footer_layouts

    lays = footer_layouts(spark, list_parquet_files(spark, str(tmp_path)))
    assert lays[0] == lays[2] != lays[1]
    df = load_trips(spark, str(tmp_path))
    assert df.columns == ["x", "y"]
    assert sorted(tuple(r) for r in df.collect()) == [(1, 10), (3, 30), (90, 9)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2  # one scan per layout


def test_folders_written_by_spark_are_entries(spark, tmp_path):
    _write(tmp_path / "a.parquet", {"x": [1], "y": [10]})
    spark.range(5).selectExpr("id as x", "id * 2 as y").repartition(3).write.parquet(str(tmp_path / "b.parquet"))
    assert load_trips(spark, str(tmp_path)).count() == 6
    assert load_trips(spark, str(tmp_path), merge="name").count() == 6
    assert load_trips(spark, str(tmp_path), names=["b.parquet"], width=1).columns == ["x"]
    with pytest.raises(ValueError):
        load_trips(spark, str(tmp_path), names=["c.parquet"])


def test_sinks_round_trip(spark, tmp_path):
    from odflow.operators import chain
    from odflow.roles import TripRoles
    from odflow.sources import write_result

    rows = [(1, 0, 1, 0, 100), (2, 1, 2, 200, 300), (3, 2, 3, 400, 450)]
    roles = TripRoles(origin="o", dest="d", start="s", end="e", distance=None, amount=None, id="id")
    trips = chain.prepare_trips(spark.createDataFrame(rows, "id long, o long, d long, s long, e long"), roles)
    solved = chain.solve_chain(trips)
    listing = chain.chain_listing(solved, chain.longest_chain(solved))
    want = sorted(map(tuple, listing.collect()))
    for fmt in ("parquet", "json"):
        write_result(listing, str(tmp_path / fmt), fmt=fmt)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "parquet")).collect())) == want
    assert spark.read.json(str(tmp_path / "json")).count() == 3
    solved.release()
