"""What a task holds: rows of a group are sorted once for each column that is ranked, and smallest distances need no sort."""

from datetime import date, datetime

from marketloom.operators import feeds, rolling, screening


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sightings_sort_no_pairs(spark):
    polls = spark.createDataFrame([("a", date(2024, 3, 4), 1, datetime(2024, 3, 4, 10), 10.0)], "symbol string, date date, poll_id long, at timestamp, price double")
    bars = spark.createDataFrame([("a", datetime(2024, 3, 4, 10), 9.0, 11.0, 10.0)], "symbol string, bar_end timestamp, low double, high double, close double")
    previous = polls.select("symbol", "date", polls["price"].alias("previous_close"))
    assert "SortAggregate" not in plan(feeds.sightings(polls, bars, previous, 2, 10, 120, 5e-5))


def test_cross_section_sorts_once(spark):
    df = spark.createDataFrame([(1, x) for x in (3.0, 1.0, 3.0, None, 2.0)], "g int, x double")
    out = df.select("x", rolling.loo_mean("x", ["g"]).alias("others"), rolling.average_rank("x", ["g"]).alias("r"), rolling.percentile_rank("x", ["g"]).alias("p"))
    assert plan(out).count("Sort [") == 1
    assert {tuple(r) for r in out.collect()} == {(None, 2.25, 0.5, None), (1.0, 8 / 3, 2.0, 0.5), (2.0, 7 / 3, 3.0, 0.75), (3.0, 2.0, 4.5, 1.125)}


def test_weighted_score_sorts_once_a_feature(spark):
    df = spark.createDataFrame([(1, 1, 3.0, 1.0), (1, 2, 1.0, None)], "g int, id int, x double, y double")
    assert plan(screening.weighted_score(df, ["g"], {"x": 0.7, "y": 0.3})).count("Sort [") <= 2
