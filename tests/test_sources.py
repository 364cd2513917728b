"""Readers and writers on generated files."""

import json
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from chronogrid.operators import align
from chronogrid.plans import studies
from chronogrid.sources import files, prices, sinks, utilisation, weather


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_missing_source_is_an_error(spark, tmp_path):
    write(tmp_path / "zon-1-uur-data.csv", "validfrom (UTC),volume (kWh)\n2024-01-01 00:00:00,1\n")
    with pytest.raises(FileNotFoundError):
        utilisation.read_history(spark, str(tmp_path))


def test_extra_columns_and_the_newest_file(spark, tmp_path):
    write(tmp_path / "zon-20240101-uur-data.csv", "x,validfrom (UTC),volume (kWh)\na,2024-01-01 00:00:00,1\na,2024-01-01 01:00:00,2\n")
    write(tmp_path / "zon-20240102-uur-data.csv", "x,validfrom (UTC),volume (kWh)\na,2024-01-01 01:00:00,5\n")
    got = utilisation.read_production(spark, f"{tmp_path}/zon-*-uur-data.csv", "sun").orderBy("ts").collect()
    assert [r["volume_sun"] for r in got] == [1.0, 5.0]


def test_headers_are_found_in_one_job(spark, tmp_path):
    """As many jobs for forty files as for four; odd names, blank and empty files."""
    for k in range(40):
        header = ["b,a", "a,b", "a,b,c"][k % 3]
        write(tmp_path / f"set {k}+x.csv", f"{header}\n{k},{k + 1}{',z' if k % 3 == 2 else ''}\n")
    write(tmp_path / "set empty.csv", "")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("few", "")
    few = files.read_csv_set(spark, [f"{tmp_path}/set {k}+x.csv" for k in range(4)])
    spark.sparkContext.setJobGroup("many", "")
    many = files.read_csv_set(spark, f"{tmp_path}/set *.csv")
    spark.sparkContext.setJobGroup("rest", "")
    jobs = [len(tracker.getJobIdsForGroup(name)) for name in ("few", "many")]
    assert jobs[1] <= jobs[0] + 2  # Spark lists many paths in a job of its own
    assert few.count() == 4
    rows = {int(re.search(r"(?:%20| )(\d+)\+x", r["_file"])[1]): r for r in many.collect()}
    assert len(rows) == 40
    for k, r in rows.items():
        first, second = (r["b"], r["a"]) if k % 3 == 0 else (r["a"], r["b"])
        assert (first, second, r["c"]) == (str(k), str(k + 1), "z" if k % 3 == 2 else None)
    for name in ("set empty.csv", "none *.csv"):
        with pytest.raises(FileNotFoundError):
            files.read_csv_set(spark, f"{tmp_path}/{name}")


def test_outer_align_says_what_it_cannot_merge(spark):
    one = spark.createDataFrame([(1, 2.0)], "k int, a double")
    two = spark.createDataFrame([(1, 3.0), (1, 4.0)], "k int, b double")
    assert align.outer_align([one, two.limit(0)], ["k"]).collect() == [(1, 2.0, None)]
    with pytest.raises(ValueError, match="more than one frame"):
        align.outer_align([one, one], ["k"])
    with pytest.raises(Exception, match="not unique: 1"):
        align.outer_align([one, two], ["k"]).collect()


def page(members, last):
    return json.dumps({"hydra:member": members, "hydra:view": {"hydra:last": f"/v1/x?a=1&page={last}"}})


def test_pages_and_their_completeness(spark, tmp_path):
    rows = [{"validfrom": f"2024-01-01T0{h}:00:00+00:00", "volume": str(h), "emissionfactor": h / 10} for h in range(4)]
    write(tmp_path / "p1.json", page(rows[:2], 2))
    pages = utilisation.read_pages(spark, str(tmp_path))
    assert not utilisation.page_check(pages).first()["is_complete"]
    with pytest.raises(ValueError, match="1 of 2 pages"):
        studies.download_job(spark, {"mix": str(tmp_path)}, str(tmp_path / "out"), "1")
    write(tmp_path / "p2.json", page(rows[2:], 2))
    pages = utilisation.read_pages(spark, str(tmp_path))
    assert utilisation.page_check(pages).first()["is_complete"]
    got = utilisation.page_members(pages, "mix").orderBy("ts").collect()
    assert [(r["total_volume"], r["emissionfactor"]) for r in got] == [(0, 0), (1, 0.1), (2, 0.2), (3, 0.3)]


def test_a_large_page_is_read_in_pieces(spark, tmp_path):
    """One page over several tasks, members with texts, blanks and line ends inside."""
    rows = [{"@id": f"/v1/{i}", "validfrom": f"2024-01-{1 + i % 9:02d}T00:00:00+00:00", "volume": str(i), "note": "a \"b\", c\n"} for i in range(20000)]
    text = json.dumps({"@context": {"x": 1}, "hydra:member": rows, "hydra:view": {"@id": "q", "hydra:last": "/v1/x?page=3"}}, indent=1)
    write(tmp_path / "p1.json", text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        pages = utilisation.read_pages(spark, str(tmp_path))
        tasks = pages.select(F.spark_partition_id()).distinct().count()
        volumes = pages.where("member IS NOT NULL").agg(F.count("*"), F.sum(F.col("member.volume").cast("long"))).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tasks > 4 and tuple(volumes) == (20000, sum(range(20000)))
    check = utilisation.page_check(pages).first()
    assert (check["expected_pages"], check["landed_pages"], check["is_complete"]) == (3, 1, False)
    manifest = utilisation.page_manifest(pages)
    assert manifest.agg(F.count("*"), F.sum("members"), F.max(F.size("files"))).first() == (9, 20000, 1)
    both = utilisation.page_manifest(pages, manifest).first()
    assert len(both["files"]) == 1


def test_a_brace_inside_a_member_is_an_error(spark, tmp_path):
    write(tmp_path / "p1.json", page([{"validfrom": "2024-01-01T00:00:00+00:00", "volume": "a}b"}], 1))
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        utilisation.read_pages(spark, str(tmp_path)).collect()


def test_weather_payload_axis(spark, tmp_path):
    payload = {"item_id": "x", "time_start": 1704067200, "time_end": 1704067200 + 3 * 3600, "interval": 3600}
    write(tmp_path / "w.json", json.dumps({**payload, "temperature_2m": [1.0, 2.0, 3.0], "rain": [0.5]}))
    got = weather.read_weather(spark, str(tmp_path)).orderBy("ts").collect()
    assert [r["ts"] for r in got] == [datetime(2024, 1, 1, h) for h in range(3)]
    assert [r["rain"] for r in got] == [0.5, None, None] and len(got[0]) == 2 + 23


def test_weather_is_filled_only_where_hours_are_missing(hourly):
    gap = hourly([1, None, 3], column="temperature").filter("temperature IS NOT NULL OR hour(ts) <> 1")
    holes = hourly([1, None, 3], item="b", column="temperature")
    nothing = gap.limit(0)
    out = weather.combine(gap.unionByName(holes), nothing, only_if_gaps=True)
    assert [r["temperature"] for r in out.filter("item_id = 'a'").orderBy("ts").collect()] == [1, 2, 3]
    assert [r["temperature"] for r in out.filter("item_id = 'b'").orderBy("ts").collect()] == [1, None, 3]


def test_price_dialects(spark, tmp_path):
    write(tmp_path / "dynamische_stroomprijzen_jaar_2024.csv", "datum;prijs;x\n01-01-2024 00:00;0,123;a\n2024-01-01 01:00:00;0.5;b\n31-02-2024 10:00;9;c\n01-01-2024 02:00;?;d\n")
    got = prices.read_electricity(spark, str(tmp_path)).orderBy("ts").collect()
    assert [r["elec_price"] for r in got] == [0.123, 0.5, pytest.approx(0.3115)]
    with pytest.raises(FileNotFoundError):
        prices.read_gas(spark, str(tmp_path))


def test_latest_file_by_date_in_its_name(spark, tmp_path):
    for stamp, v in (("20240201", 1), ("2024-03-05", 2), ("2024_02_28", 3)):
        write(tmp_path / f"historical_combined_{stamp}.csv", f"time,emissionfactor\n2024-01-01 00:00:00,{v}\n")
    got = files.read_emissions(spark, f"{tmp_path}/historical_combined_*.csv").first()
    assert got["emission_factor"] == 2.0 and got["ts"] == datetime(2024, 1, 1)


def test_snapshot_replaces_only_its_own_date(spark, hourly, tmp_path):
    path = str(tmp_path / "snap")
    for snapshot, rows in (("2024-01-01", [1, 2]), ("2024-01-02", [3, 4, 5]), ("2024-01-02", [6])):
        sinks.write_snapshot(hourly(rows), path, snapshot)
    got = {str(r["snapshot_date"]): r["n"] for r in spark.read.parquet(path).groupBy("snapshot_date").agg(F.count("*").alias("n")).collect()}
    assert got == {"2024-01-01": 2, "2024-01-02": 1}


def test_request_windows_and_landed_filter(spark):
    assert utilisation.window_of("forecast", date(2024, 1, 1)) == (date(2024, 1, 1), date(2024, 1, 8))
    assert utilisation.window_of("runup", date(2024, 1, 29)) == (date(2024, 1, 1), date(2024, 1, 29))
    rows = [(2, 2, datetime(2024, 1, 1)), (2, 2, datetime(2024, 1, 2)), (2, 1, datetime(2024, 1, 1)), (27, 2, datetime(2024, 1, 1))]
    landed = spark.createDataFrame(rows, "type int, classification int, ts timestamp")
    got = utilisation.select_landed(landed, "sun", "history", date(2024, 1, 1), date(2024, 1, 2))
    assert got.count() == 1


def test_outside_names_survive_a_round_trip(spark, hourly, tmp_path):
    df = hourly([1, 2], column="volume_land_wind").drop("item_id")
    path = sinks.write_history(df, str(tmp_path / "h.csv"))
    assert "volume_land-wind" in spark.read.option("header", True).csv(path).columns
    assert files.read_series(spark, path).columns == ["ts", "volume_land_wind"]
