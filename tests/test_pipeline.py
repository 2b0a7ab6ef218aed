"""Raw files in, stage tables and a model out."""

import random

import pytest
from pyspark.sql import functions as F

from checks import standins as si
from checks.queries import raw_grid
from quartergrid.config import POI_FIELDS, RAW_GRID_COLUMNS
from quartergrid.plans import pipeline as pl
from quartergrid.session import shared_folder
from quartergrid.sources import readers, tables
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("inputs"))
    stamp = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    si.traffic(spark, SF).select(*(
        (F.date_format(new, stamp) if new.endswith("_utc") else F.col(new).cast("string")).alias(old)
        for old, new in readers.TRAFFIC_FIELDS.items()
    )).unionByName(spark.createDataFrame([
        ("x", "2024-01-10 00:00:00", "30.2", "-97.7", "KAUS", "Accident", "a"),
        ("2024-01-10 00:00:00", "2024-01-10 00:00:00", "n", "-97.7", "KAUS", "Accident", "b"),
        ("2024-01-10 00:00:00", "x", "30.2", "-97.7", "KAUS", "Accident", "c"),
    ], [*readers.TRAFFIC_FIELDS])).write.option("header", True).csv(f"{root}/traffic")
    weather = si.observation_text(spark, SF).drop("obs_id")
    weather.write.partitionBy("airport").option("header", True).csv(f"{root}/weather")
    si.daylight_text(spark, SF).write.csv(f"{root}/daylight")
    poi = si.poi(spark, SF).withColumnRenamed("cell", "Geohash")
    twice = poi.limit(1)
    poi.unionByName(twice).unionByName(twice).write.option("header", True).csv(f"{root}/poi")
    words = spark.createDataFrame([("{k:", "1 2"), ("bad", "1"), ("worse", "1 x")], "w string, v string")
    words.select(F.concat_ws(" ", "w", "v")).write.text(f"{root}/words")
    return pl.Inputs(*(f"{root}/{n}" for n in ("traffic", "weather", "daylight", "poi", "words")))


def test_run(spark, inputs, tmp_path):
    s = pl.Settings(cities=si.CITIES, window=si.WINDOW, grid_period=si.PERIOD, text_period=si.PERIOD,
                    text_dims=2, keep_share=0.2)
    paths = pl.run(spark, inputs, str(tmp_path), s)
    read = {n: tables.load(spark, p) for n, p in paths.items()}
    assert rows(read["copies_poi"], "copies", "differ") == [(3, False)]
    assert {r.reject for r in read["reject_traffic"].collect()} == {"start", "point", "end"}
    assert read["reject_traffic"].filter("reject = 'point'").count() == 1
    assert read["reject_weather"].filter("raw is null").count() == 0
    assert rows(read["reject_airports"]) == [] and read["reject_days"].count() > 0
    assert rows(read["word_vectors"], "word") == [("{k:",)]
    assert rows(read["reject_word_vectors"], "word") == [("bad",), ("worse",)]
    assert {r.reject for r in read["reject_weather"].select("reject").distinct().collect()} == {"time", "number"}
    cells = read["seen"].select("city", "cell").distinct().count()
    assert read["grid"].count() == cells * 2015
    coded = read["grid"].filter("cell_code is not null").select("city", "cell").distinct().count()
    assert coded < cells and read["reject_cells"].count() > 0
    assert read["grid_clean"].count() == coded * 2014
    assert read["examples"].select(F.size("feature")).distinct().first()[0] == 8 * 25 + 14 + 2 + 1
    models = {r.city: r for r in pl.city_models(read["examples"], si.CITIES).collect()}
    assert set(models) <= {c.name for c in si.CITIES} and "Austin" in models
    for got in models.values():
        assert got.accuracy == pytest.approx(got.weighted_recall) and got.width == 217
    assert pl.city_models(read["examples"].filter("false"), si.CITIES).count() == 0


def test_weather_files_named_by_airport(spark, tmp_path):
    head = "Date,Hour,Temp,WindChill,Humd,Pressure,Visib,WindSpeed,WindDir,Precipitation,Events,Conditions\n"
    (tmp_path / "KAUS.csv").write_text(
        head + "2018-06-01,1:53 PM,80,80,40,29.9,10,5,N,0,,Clear\n2018-06-01,1:53 PM,81,80,40,29.9,10,5,N,0,,Clear\n"
        "2018-06-01,2:53 PM,81,,40,29.9,10,5,N,0,,Clear\n")
    (tmp_path / "KXXX.csv").write_text(head + "2018-06-01,1:53 PM,80,80,40,29.9,10,5,N,0,Rain,\n")
    parsed = readers.parse_observations(readers.read_observations(spark, str(tmp_path)))
    assert rows(parsed, "airport", "temperature", "reject") == [
        ("KAUS", 80.0, None), ("KAUS", 81.0, "number"), ("KAUS", 81.0, None), ("KXXX", 80.0, None)]
    first = parsed.filter("reject is null and airport = 'KAUS'").orderBy("obs_id").first()
    assert first.temperature == 80.0


def test_weather_files_with_headers_of_their_own(spark, tmp_path):
    names = "Date,Hour,Temp,WindChill,Humd,Pressure,Visib,WindSpeed,WindDir,Precipitation,Events,Conditions".split(",")
    row = dict(zip(names, "2018-06-01,1:53 PM,80,70,40,29.9,10,5,N,0,Hail,Clear".split(",")))
    rng = random.Random(2)
    orders = [names, *(rng.sample(names, len(names)) for _ in range(30))]
    orders[3] = ["Station", "Date", *names[1:], "More"]
    orders[4] = [c for c in names if c not in ("Events", "Humd")]
    for i, order in enumerate(orders):
        head = ",".join(f'"{c}"' if i == 5 else c for c in order) + ("\r" if i == 6 else "")
        lines = [",".join(row.get(c, "x") for c in order)] * (2 + i)
        (tmp_path / f"K{i:02}.csv").write_text("\n" * (i == 7) + "\n".join([("\uFEFF" if i == 8 else "") + head, *lines]) + "\n")
    (tmp_path / "K99.csv").write_text("")
    text = readers.read_observations(spark, str(tmp_path))
    assert text._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    read = text.drop("obs_id").groupBy(*(c for c in text.columns if c != "obs_id")).count().collect()
    assert {r.airport: r["count"] for r in read} == {f"K{i:02}": 2 + i for i in range(31)}
    for r in read:
        for c in names:
            lacks = r.airport == "K04" and c in ("Events", "Humd")
            assert c == "WindDir" or r[{"Events": "events", "Conditions": "conditions"}.get(c, c)] == (None if lacks else row[c]), (r, c)
    rejects = readers.parse_observations(text).filter("reject is not null")
    assert {r.airport for r in rejects.collect()} == {"K04"}


def test_duplicates(spark):
    df = spark.createDataFrame([("a", 1, [1.0]), ("b", 1, [1.0]), ("a", 2, None)], "k string, v int, x array<double>")
    one, copies = readers.collapse_copies(df.unionByName(df.filter("k = 'b'")), "k")
    assert rows(one) == [("a", 2, None), ("b", 1, [1.0])]
    assert rows(copies) == [("a", 2, True), ("b", 2, False)]


def test_grid_csv_round_trip(spark, tmp_path):
    grid = raw_grid(spark, SF)
    path = tables.save_grid_csv(grid, str(tmp_path / "grid"))
    header = spark.read.text(f"{path}/city=Austin").first()[0].split(",")
    assert header[:6] == ["Geohash", "TimeStep", "DOW", "HOD", "DayLight", "T-Accident"] and len(header) == 23
    back = tables.load_grid_csv(spark, path)
    assert rows(back) == rows(grid.select("city", *RAW_GRID_COLUMNS))


def test_poi_reader_rejects_bad_counts(spark, tmp_path):
    from quartergrid.operators.features import unusable_poi, usable_poi
    line = lambda c, v: ",".join([c, *([v] * 14)])
    (tmp_path / "poi.csv").write_text("\n".join(["Geohash," + ",".join(POI_FIELDS), line("a", "1"), line("b", "x")]))
    read = readers.read_poi(spark, str(tmp_path))
    assert read.count() == 2 and rows(usable_poi(read), "cell") == [("a",)]
    assert rows(unusable_poi(read), "cell") == [("b",)]


def test_shared_folder_follows_the_session():
    from types import SimpleNamespace

    def session(master, **conf):
        return SimpleNamespace(sparkContext=SimpleNamespace(master=master),
                               conf=SimpleNamespace(get=lambda key, default: conf.get("folder", default)))

    assert shared_folder(session("yarn", folder="hdfs://nn/work/")) == "hdfs://nn/work"
    with pytest.raises(ValueError):
        shared_folder(session("yarn"))
    assert shared_folder(session("local[2]")) == shared_folder(session("local[2]"))
