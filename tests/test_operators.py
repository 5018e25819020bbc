"""Operators on small hand-made tables: plain loops, causality, no repaint, sinks and streams."""

import datetime as dt
import json
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions import expr as X
from marketloom.operators import analog, asof, daily, intraday, news, rolling, scoring
from marketloom.sources import io
from marketloom.streaming import streams


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_value_area_by_loop(spark):
    rng = random.Random(4)
    rows = [[float(rng.randrange(0, 9)) for _ in range(rng.randrange(1, 30))] for _ in range(60)]
    rows = [r if sum(r) else [1.0] for r in rows]
    got = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, h array<double>").select("i", intraday.value_area(F.col("h")).alias("a")).collect()
    for r in got:
        h = rows[r.i]
        low = high = h.index(max(h))
        held = h[low]
        while held < 0.7 * sum(h):
            below, above = h[low - 1] if low else None, h[high + 1] if high + 1 < len(h) else None
            if above is not None and (below is None or above >= below):
                high += 1
                held += above
            else:
                low -= 1
                held += below
        assert (r.a.low, r.a.high) == (low, high) and abs(r.a.held - held) < 1e-9


def legs(prices, threshold):
    x = [math.log(p) for p in prices]
    direction, pivot, extreme, age, n, out = 0, x[0], x[0], 0, 0, []
    for p in x:
        ref_low, ref_high = min(extreme, pivot), max(extreme, pivot)
        up = p - ref_low >= threshold if direction == 0 else direction < 0 and p - extreme >= threshold
        down = ref_high - p >= threshold if direction == 0 else direction > 0 and extreme - p >= threshold
        if up or down:
            if direction:
                pivot = extreme
            direction, extreme, age, n = (1 if up else -1), p, 0, n + 1
        else:
            age += 1
            further = p > extreme if direction == 1 else p < extreme if direction == -1 else abs(p - pivot) > abs(extreme - pivot)
            extreme = p if further else extreme
        out.append((direction, round(extreme - pivot, 9), age, n))
    return out


def test_zigzag_by_loop_and_no_repaint(spark):
    rng = random.Random(6)
    prices = [100.0]
    for _ in range(120):
        prices.append(prices[-1] * math.exp(rng.gauss(0, 0.02)))
    cuts = [10, 40, 121]
    df = spark.createDataFrame([(c, prices[:c]) for c in cuts], "c int, p array<double>").select("c", intraday.zigzag(F.col("p"), 0.05).alias("z"))
    for r in df.collect():
        assert [(z.dir, round(z.length, 9), z.age, z.legs) for z in r.z] == legs(prices, 0.05)[: r.c]


def test_hysteresis_and_rearming(spark):
    ranks = [40, 20, 30, 36, 25, 19, 35, 34, 50]
    values = [0.1, 0.9, 0.95, 0.2, 0.99, 0.8, 0.9, 0.1, 0.9]
    row = one(spark, rolling.hysteresis(F.array(*map(F.lit, ranks))), rolling.rearming(F.array(*[F.lit(i) for i in range(9)]), F.array(*map(F.lit, values)), 0.8, 3))
    assert row.c0 == [False, True, True, False, False, True, True, True, False]
    assert row.c1 == [1, 4, 8]


def test_no_look_ahead(spark):
    """Changing later bars leaves every feature of earlier rows as it was."""
    rng = random.Random(8)
    rows = [(s, dt.date(2024, 1, 1) + dt.timedelta(days=i), i + 1, *(rng.uniform(9, 11) for _ in range(5)), rng.uniform(1, 5), 1) for s in (1, 2) for i in range(60)]
    schema = "symbol long, date date, day_idx int, open double, high double, low double, close double, vwap double, volume double, trades long"
    changed = [(*r[:3], *(x * 3 for x in r[3:9]), r[9]) if r[2] > 40 else r for r in rows]
    for f in (lambda b: daily.true_range(b), lambda b: daily.daily_volatility(daily.session_returns(b), 20, 5), lambda b: daily.forward_vwaps(b).select("symbol", "day_idx", "pct_prev", "vol_10d_mean", "vol_ma20")):
        a, b = ({(r.symbol, r.day_idx): r for r in f(spark.createDataFrame(x, schema)).collect() if r.day_idx <= 40} for x in (rows, changed))
        assert a and a == b


def test_asof_edges(spark):
    left = spark.createDataFrame([(1, 5), (1, 1), (2, 5), (1, None)], "k int, t int")
    right = spark.createDataFrame([(1, 5, "a"), (1, 3, "b"), (1, 9, "c")], "k int, t int, v string")
    get = lambda **o: {(r.k, r.t): r.v for r in asof.asof_join(left, right.withColumnRenamed("t", "rt"), ["k"], "t", "rt", **o).collect()}
    assert get() == {(1, 5): "a", (1, 1): None, (2, 5): None}
    assert get(strict=True) == {(1, 5): "b", (1, 1): None, (2, 5): None}
    assert get(direction="forward") == {(1, 5): "a", (1, 1): "b", (2, 5): None}
    assert get(direction="forward", strict=True) == {(1, 5): "c", (1, 1): "b", (2, 5): None}
    assert get(strict=True, tolerance=1) == {(1, 5): None, (1, 1): None, (2, 5): None}


def test_forecast_functions(spark):
    q = F.array(*[F.lit(z) for z in scoring.Z])
    row = one(spark, X.prob_below(q, F.lit(0.0), scoring.TAUS), X.prob_below(q, F.lit(-9.0), scoring.TAUS), X.quantile_at(q, 0.5, scoring.TAUS), X.cdf_tails(q, F.lit(9.0), scoring.TAUS), X.percentile_of(q, F.lit(9.0), scoring.TAUS), X.bucket(F.lit(1.0), [0.0, 0.5, 1.0]), X.bucket(F.lit(1.1), [0.0, 0.5, 1.0]), X.pack_mask([F.lit(True), F.lit(None), F.lit(True)]), *X.wilson(F.lit(5), F.lit(10)))
    assert row.c0 == 0.5 and row.c1 == 0.05 and row.c2 == 0.0 and 0.95 < row.c3 < 1 and row.c4 == 0.975
    assert (row.c5, row.c6, row.c7) == (1, -1, 5)
    assert abs(row.c8 - 0.2366) < 1e-3 and abs(row.c9 - 0.7634) < 1e-3


def test_sources(spark, tmp_path):
    (tmp_path / "daily-2024-01-02.jsonl").write_text('{"ticker": "A", "close": 1.5}\n{"ticker": null, "close": 2}\n')
    (tmp_path / "daily-2024-01-03.jsonl").write_text('{"ticker": "B", "close": 3, "extra": 1}\nnot json\n')
    schema = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("close", T.DoubleType())])
    assert [r.ticker for r in io.read_jsonl(spark, str(tmp_path / "*.jsonl"), schema, key="ticker").orderBy("ticker").collect()] == ["A", "B"]
    assert [r.ticker for r in io.read_jsonl(spark, str(tmp_path / "*.jsonl"), schema, since="2024-01-03", key="ticker").collect()] == ["B"]
    out = str(tmp_path / "dated")
    df = spark.createDataFrame([("2024-01-02", 2), ("2024-01-02", 1), ("2024-01-03", 5)], "date string, x int").withColumn("date", F.to_date("date"))
    io.write_dated(df, out, sort=("x",))
    io.write_dated(df.filter("x = 5").withColumn("x", F.lit(6)), out)
    assert sorted(r.x for r in spark.read.parquet(out).collect()) == [1, 2, 6]
    poll = spark.createDataFrame([(1, ["Symbol", "Last", "Bid", "Volume"], [["AA ", "--", "1,234.5", "0"], ["", "1", "1", "1"], ["B", "2%", "9", "7"]])], "ts int, headers array<string>, rows array<array<string>>")
    got = {r.symbol: (r.price, r.volume) for r in io.watchlist_rows(poll, ["Last", "Bid"], ["Volume"]).collect()}
    assert got == {"AA": (1234.5, None), "B": (2.0, 7.0)}
    tree = json.dumps([{"name": "Assets", "data": [{"value": "1"}, {"value": "x"}], "children": [{"name": "Cash", "data": [{"value": "3"}]}]}])
    flat = io.flatten_tree(spark.createDataFrame([(1, tree)], "k int, t string"), "k", "t").collect()
    assert [(r.code, r.position, r.value) for r in flat] == [("Assets", 0, 1.0), ("Assets", 1, None), ("Cash", 0, 3.0)]


def test_news_text(spark):
    df = spark.createDataFrame([("Acme Corp., Inc.", "21h ago", ""), ("The Co of X", "3d", "Please subscribe to read")], "name string, age string, body string")
    got = df.select(news.normal_name("name").alias("n"), news.age_minutes("age").alias("a"), news.body_status("body").alias("s")).collect()
    assert [tuple(r) for r in got] == [("acme", 1260, "missing"), ("of x", 4320, "paywalled")]


def test_stream_ingest_and_restart(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    batch = lambda i, key=None, version=1: json.dumps({"schema_version": version, "source": "s", "kind": "poll", "ts_utc": f"2024-01-02T14:3{i}:00Z", "feed_seq": i, "rows": [{"symbol": "A", "price": 1.0 + i, "volume": 2.0}], "_key": key or f"k{i}"})
    (inbox / "a.txt").write_text("\n".join([batch(0), batch(1), batch(1), "broken", batch(2, version=9)]))
    run = lambda: streams.split_sink(streams.parsed(spark.readStream.text(str(inbox))), str(tmp_path / "out"), str(tmp_path / "cp")).start().awaitTermination()
    run()
    (inbox / "b.txt").write_text(batch(3))
    run()  # goes on from the checkpoint
    rows = spark.read.parquet(str(tmp_path / "out" / "rows"))
    good = rows.filter("kind = 'good'")
    assert sorted(r.feed_seq for r in good.collect()) == [0, 1, 1, 3] and {r.hour for r in good.collect()} == {9}
    assert sorted(r.problem for r in rows.filter("kind = 'bad'").collect()) == ["unparseable", "version"]
    rows = streams.poll_rows(streams.once(streams.parsed(spark.readStream.text(str(inbox))).select("value", "problem", "b", F.col("b.ts_utc").alias("ts_utc"), F.col("b._key").alias("_key")).filter("problem IS NULL")))
    streams.sink(rows, str(tmp_path / "table"), str(tmp_path / "cp2")).start().awaitTermination()
    assert sorted(r.feed_seq for r in spark.read.parquet(str(tmp_path / "table")).collect()) == [0, 1, 3]


def test_messages_and_liveness(spark):
    t = dt.datetime(2024, 1, 2, 15, 0, 0)
    msgs = spark.createDataFrame([("rec", 1, t, t), ("rec", 2, t, t), ("odd", 1, t, t), (None, 1, t, t), ("rec", 1, t + dt.timedelta(seconds=6), t)], "type string, schema_version int, ts timestamp, sent timestamp")
    assert {(r.type, r.problem): r["count"] for r in streams.problem_counts(msgs, ["rec"], "sent").collect()} == {("rec", "version"): 1, ("odd", "unknown type"): 1, (None, "unparseable"): 1, ("rec", "clock"): 1}
    status = spark.createDataFrame([("a", t), ("b", t - dt.timedelta(seconds=200))], "party string, ts timestamp")
    assert {r.party: r.offline for r in streams.stale(status, t).collect()} == {"a": False, "b": True}


def test_analog_kernel_by_loop(spark):
    rng = random.Random(9)
    rows = [(s, day, rng.gauss(0, 1), rng.gauss(0, 1), rng.gauss(0, 1)) for s in range(4) for day in range(40)]
    lib = spark.createDataFrame(rows, "symbol long, day_idx int, after double, a double, b double")
    got = {(r.symbol, r.day_idx, r.m_symbol, r.m_day): r.w for r in analog.matches(lib.filter("symbol = 0"), lib, ["a", "b"], 0.5, 10).collect()}
    s = analog.spreads(lib, ["a", "b"]).first()
    want = {}
    for q in rows:
        for m in rows:
            za, zb = abs(q[3] - m[3]) / (0.5 * s.s_a), abs(q[4] - m[4]) / (0.5 * s.s_b)
            if q[0] == 0 and q[1] - 10 <= m[1] < q[1] and za < 1 and zb < 1:
                want[q[0], q[1], m[0], m[1]] = (1 - za * za) * (1 - zb * zb)
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_calibrated_forecasts_say_so(spark):
    """Forecasts from the law of the outcome are calibrated; shifted ones are optimistic."""
    base = spark.range(6000).select(F.col("id"), F.randn(7).alias("actual"), F.array(*[F.lit(z) for z in scoring.Z]).alias("q"))
    shifted = base.withColumn("q", F.transform("q", lambda x: x + 0.5))
    labels = [scoring.bias(scoring.scored(x).withColumn("g", F.lit(1)), ["g"]).first().label for x in (base, shifted)]
    assert labels == ["calibrated", "optimistic"]
    cover = scoring.quantile_table(base).collect()
    assert all(abs(r.tau - r.share) < 0.02 for r in cover)


@pytest.mark.parametrize("n", [0, 1])
def test_tiny_tables(spark, n):
    t = spark.createDataFrame([(1, dt.date(2024, 1, 2), 5.0, 2.0, 1, 1)], "symbol long, date date, price double, volume double, seq1 long, seq2 int").limit(n)
    b = daily.daily_bars(t).join(daily.calendar(t).select("date", "day_idx"), "date")
    assert daily.forward_vwaps(b).count() == n and daily.session_returns(b).count() == 0
    assert analog.moments(b).count() == 0


def test_capped_moves_by_bisection(spark):
    from marketloom.operators import screening

    rng = random.Random(12)
    rows = [(g, i, rng.paretovariate(0.7), rng.gauss(0, 1)) for g in range(12) for i in range(rng.randrange(3, 15))]
    df = spark.createDataFrame(rows, "g int, id int, cap double, move double")
    for r in screening.capped_moves(df, ["g"], "id", "cap", "move").collect():
        others = [(c, m) for g, i, c, m in rows if g == r.g and i != r.id]
        if len(others) * 0.25 < 1:
            want = sum(c * m for c, m in others) / sum(c for c, _ in others)
        else:
            low, high = 0.0, 1e9
            for _ in range(300):
                s = (low + high) / 2
                low, high = (s, high) if sum(min(0.25, s * c) for c, _ in others) < 1 else (low, s)
            want = sum(min(0.25, s * c) * m for c, m in others)
        assert abs(r.others_move - want) < 1e-6


def test_article_bodies(spark):
    from marketloom.operators import news

    html = '<html lang="en"><head><title>A b</title></head><nav>menu</nav><p>One <b>two</b></p><script>x = 1</script> three</html>'
    pages = spark.createDataFrame([(1, "https://www.site.org/x", html), (2, None, None)], "page_id long, url string, html string")
    got = {r.page_id: r for r in news.articles(pages).collect()}
    assert got[1].body == "One two three" and got[1].title == "A b" and got[1].site == "site.org" and got[2].body == ""


def test_attribution_phrases_and_cashtags(spark):
    from marketloom.operators import news

    names = spark.createDataFrame([(1, "Blue-Sky Holdings", "BSK"), (2, "Blue", None), (3, "sky holdings two", "XX")], "symbol long, name string, ticker string")
    docs = spark.createDataFrame([(1, "The blue sky, holdings fell"), (2, "blue skies $BSK up"), (3, "$ZZZ or bsk"), (4, None), (5, "$XXY sky holdings")], "doc_id long, text string")
    got = {tuple(r) for r in news.attribute(docs, names).collect()}
    assert got == {(1, 1, "phrase"), (1, 2, "phrase"), (2, 2, "phrase"), (2, 1, "cashtag")}


def test_window_lookup_strict(spark):
    import pytest as pt

    from marketloom.operators import asof

    w = spark.sql("SELECT timestamp'2024-01-01 22:00:00' AS s, timestamp'2024-01-03 02:00:00' AS e, 7 AS id")
    points = spark.sql("SELECT * FROM VALUES (timestamp'2024-01-01 21:59:59'), (timestamp'2024-01-01 22:00:00'), (timestamp'2024-01-02 12:00:00'), (timestamp'2024-01-03 02:00:00') AS t(at)")
    assert [r.id for r in asof.in_window(points, w, "at", "s", "e").orderBy("at").collect()] == [None, 7, 7, None]
    with pt.raises(Exception, match="no window"):
        asof.in_window(points, w, "at", "s", "e", strict=True).collect()


def test_move_outcomes_and_chances(spark):
    from marketloom.operators import moves

    prints = spark.createDataFrame([("a", 2, 110.0, 3.0), ("a", 2, 90.0, 1.0), ("a", 3, 100.0, 5.0)], "symbol string, n int, price double, volume double")
    decisions = spark.createDataFrame([("a", 1, 100.0, 0.5)], "symbol string, n int, price double, sigma double")
    made = {r.win: r for r in moves.centres(prints, decisions, 3).collect()}
    assert set(made) == {1, 2}
    assert made[1].mass_up == 0.75 and abs(made[1].centre_up - math.log(1.1) / 0.5) < 1e-12 and abs(made[1].centre_down + math.log(0.9) / 0.5) < 1e-12
    assert made[2].centre_up is None and made[2].centre_down is None
    rows = spark.createDataFrame([(True, 0.5, 0.75, 0.2, 0.2), (False, 0.5, 0.99, 0.2, 9.0), (True, 0.5, None, None, None)], "up boolean, sigma double, mass_up double, centre_up double, centre_down double")
    out = [(r.formed, r.reached) for r in moves.move_outcome(rows, 0.05).collect()]
    assert out == [(1, 1), (0, 0), (None, None)]
    taus, q = [0.05, 0.25, 0.5, 0.75, 0.95], [0.1, 0.2, 0.3, 0.4, 0.5]
    rows = spark.createDataFrame([("a", 1, True, 1.0, q, None, 0.1), ("a", 2, True, 1.0, q, None, None)], "k string, win int, up boolean, sigma double, q_centre array<double>, q_mass array<double>, centre_move double")
    c = moves.move_chance(rows, math.expm1(0.3), taus).withColumns({"formed": F.lit(1), "reached": F.lit(0)})
    got = moves.cumulative(c, ["k", "up"], "win").orderBy("win").collect()
    assert [round(r.p, 9) for r in got] == [0.5, 0.5] and [round(r.p_any, 9) for r in got] == [0.5, 0.75]
    assert [r.best_window for r in got] == [1, 1] and got[1].furthest == 0.1


def test_reconcile_and_index(spark):
    from marketloom.operators import extended

    rows = spark.createDataFrame([("x", 10.0, 20.0, 5.0, 5.01), ("x", 30.0, 20.0, 5.0, 6.0), ("x", 0.0, 20.0, None, 6.0), ("x", 5.0, 0.0, 1.0, 1.0)], "g string, a double, b double, p double, q double")
    got = {r.pair: r for r in extended.reconcile(rows, ["g"], {"v": ("a", "b")}, {"c": ("p", "q")}).collect()}
    assert (got["v"].n, got["v"].median, got["v"].least, got["v"].largest, got["v"].hits) == (2, 1.0, 0.5, 1.5, None)
    assert (got["c"].n, got["c"].hits, got["c"].median) == (3, 2, None)
    assert extended.reconcile(rows.filter("g = ''"), ["g"], {"v": ("a", "b")}, {"c": ("p", "q")}).count() == 0
    day = dt.date(2024, 1, 1)
    m = spark.createDataFrame([("i", day + dt.timedelta(days=k), 571, 10.0 + k, float(k), 10.0) for k in range(4)], "symbol string, date date, minute int, close double, volume double, vwap double")
    got = {(r.date, r.minute): r for r in extended.index_minutes(m, 3).collect()}
    assert len(got) == 4 * 390 and got[day, 571].day_vwap is None  # the first day's only bar has no volume
    last = day + dt.timedelta(days=3)
    assert got[last, 570].close is None and got[last, 959].close == 13.0 and got[last, 571].normal_volume == 1.0 and got[last, 572].normal_volume == 0.0


def test_climatology_and_sweep(spark):
    from marketloom.operators import analog

    lib = spark.createDataFrame([(1, 0.12), (1, -0.3), (2, 9.0), (3, 0.0)], "day_idx int, after double")
    got = {(r.day_idx, r.win): (r.c_up, [round(x, 3) for x in r.c_q]) for r in analog.climatology(lib, [1, 5], [0.1, 0.9]).collect()}
    assert got == {(2, 1): (0.5, [-0.275, 0.125]), (2, 5): (0.5, [-0.275, 0.125]), (3, 1): (1.0, [5.025, 5.025]), (3, 5): (2 / 3, [-0.275, 5.025])}
    found = spark.createDataFrame([("a", 10, 9, 0.1, [0.5, 0.0]), ("a", 10, 2, 0.1, [0.1, 0.2])], "symbol string, day_idx int, m_day int, m_after double, z array<double>")
    got = {(r.m_day, r.dial, r.win): round(r.w, 6) for r in analog.sweep(found, 0.4, [0.2, 0.4], [3, 10]).collect()}
    assert got == {(9, 0.4, 3): 0.75, (9, 0.4, 10): 0.75, (2, 0.2, 10): round((1 - 0.04) * (1 - 0.16), 6), (2, 0.4, 10): round(0.99 * 0.96, 6)}
