"""Queries over chances of moves, forecasts in force, agreement of two feeds, and an index's series."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.operators import extended, moves
from marketloom.operators.scoring import TAUS, Z
from marketloom.plans.base import BARS, bars, query, read, releases, rounded, trades
from marketloom.plans.extended import PRINTS, parts
from marketloom.plans.scoring import FORECASTS, cdf, forecasts
from marketloom.staging import written

SIZE, WINDOWS = 0.2, 3
_DISTANCE = [0.2, 0.5, 0.8, 1.2, 1.8]


def _tails(q: str, x: str) -> str:
    """SQL of a CDF with exponential tails."""
    at = lambda i: f"{q}[{i}]"
    steps = " ".join(f"WHEN {x} < {at(i + 2)} THEN {TAUS[i]} + ({x} - {at(i + 1)}) / ({at(i + 2)} - {at(i + 1)}) * {TAUS[i + 1] - TAUS[i]!r}" for i in range(4))
    return f"CASE WHEN {x} < {at(1)} THEN 0.05 * exp(({x} - {at(1)}) / ({at(2)} - {at(1)})) WHEN {x} > {at(5)} THEN 1 - 0.05 * exp(-({x} - {at(5)}) / ({at(5)} - {at(4)})) {steps} ELSE 0.95 END"


MOVES = FORECASTS + f""", nb AS (SELECT symbol, date, vwap, row_number() OVER (PARTITION BY symbol ORDER BY date) AS n FROM bars)
 , pr AS (SELECT symbol, n, price, volume FROM t JOIN nb USING (symbol, date)), dc AS (SELECT symbol, n, vwap AS price, sigma, actual FROM fc JOIN nb USING (symbol, date))
 , yy AS (SELECT d.symbol, d.n, p.n - d.n AS win, volume, ln(p.price / d.price) / d.sigma AS y FROM dc d JOIN pr p ON p.symbol = d.symbol AND p.n BETWEEN d.n + 1 AND d.n + {WINDOWS})
 , ct AS (SELECT symbol, n, win, sum(CASE WHEN y > 0 THEN volume ELSE 0 END) / sum(volume) AS mass_up, sum(volume * y) FILTER (WHERE y > 0) / sum(volume) FILTER (WHERE y > 0) AS c_up, sum(-volume * y) FILTER (WHERE y < 0) / sum(volume) FILTER (WHERE y < 0) AS c_dn FROM yy GROUP BY ALL)
 , rw AS (SELECT d.*, w.win, s.up, [{", ".join(f"{k} * sqrt(w.win) * (1 + abs(d.actual))" for k in _DISTANCE)}] AS qc, [{", ".join(f"0.5 + d.actual / 2 + {z!r} * 0.15" for z in Z)}] AS qm, CASE WHEN up THEN ln(1 + {SIZE}) ELSE -ln(1 - {SIZE}) END AS lv FROM dc d, (SELECT unnest(range(1, {WINDOWS + 1})) AS win) w, (VALUES (true), (false)) s(up))
 , mc AS (SELECT *, CASE WHEN up THEN 1 - ({_tails("qm", "0.05")}) ELSE {_tails("qm", "0.95")} END AS p_forms, 1 - ({_tails("qc", "(lv / sigma)")}) AS p_beyond FROM rw)
 , oc AS (SELECT *, p_forms * p_beyond AS p, CASE WHEN (CASE WHEN up THEN mass_up ELSE 1 - mass_up END) >= 0.05 THEN CASE WHEN up THEN c_up ELSE c_dn END END AS centre FROM mc LEFT JOIN ct USING (symbol, n, win))
 , mo AS (SELECT *, CASE WHEN mass_up IS NOT NULL THEN (centre IS NOT NULL)::INT END AS formed, CASE WHEN mass_up IS NOT NULL THEN coalesce(centre * sigma >= lv, false)::INT END AS reached, exp(CASE WHEN up THEN 1 ELSE -1 END * sigma * centre) - 1 AS centre_move FROM oc)"""


def chances(spark, d):
    by_date = Window.partitionBy("symbol").orderBy("date")
    # Bars are used as decisions and for the numbers of prints, decisions for their outcomes and as rows: each is made once.
    numbered = written(bars(spark, d).select("symbol", "date", "day_idx", "vwap", F.row_number().over(by_date).alias("n")), "bars")
    prints = trades(spark, d).join(numbered.select("symbol", "date", "n"), ["symbol", "date"]).select("symbol", "n", "price", "volume")
    dec = written(forecasts(spark, d, numbered, ("n", "vwap")).select("symbol", "n", F.col("vwap").alias("price"), "sigma", "actual"), "decisions")
    # A decision's windows and sides stay in one partition, from the join with what the prints made of it to the sums over its windows.
    found = ("mass_up", "centre_up", "centre_down")
    made = moves.centres(prints, dec.select("symbol", "n", "price", "sigma"), WINDOWS).repartition("symbol", "n")
    made = made.groupBy("symbol", "n").agg(F.collect_list(F.struct("win", *found)).alias("made"))  # at most WINDOWS
    asked = dec.join(made, ["symbol", "n"], "left").select("*", F.explode(F.sequence(F.lit(1), F.lit(WINDOWS))).alias("win"))
    own = F.get(F.filter("made", lambda x: x["win"] == F.col("win")), F.lit(0))
    rows = asked.withColumns({c: own[c] for c in found}).drop("made").select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("up"))
    rows = rows.withColumns({
        "q_centre": F.array(*[F.lit(k) * F.sqrt("win") * (1 + F.abs("actual")) for k in _DISTANCE]),
        "q_mass": F.array(*[0.5 + F.col("actual") / 2 + F.lit(z) * 0.15 for z in Z]),
    })
    return moves.move_outcome(moves.move_chance(rows, SIZE, TAUS), SIZE)


@query(MOVES + " SELECT symbol, n, win, up, f32(p_forms) AS p_forms, f32(p_beyond) AS p_beyond, f32(p) AS p, formed, reached, f32(centre_move) AS centre_move FROM mo")
def o205_move_chances(spark, d):
    return rounded(chances(spark, d).select("symbol", "n", "win", "up", "p_forms", "p_beyond", "p", "formed", "reached", "centre_move"))


@query(MOVES + """, li AS (SELECT symbol, n, up, list({'win': win, 'p': p, 'formed': formed, 'reached': reached, 'cm': centre_move, 'mid': qc[3]} ORDER BY win) AS l FROM mo GROUP BY ALL),
 ix AS (SELECT symbol, n, up, l, unnest(range(1, len(l) + 1)) AS i FROM li),
 cu AS (SELECT symbol, n, up, l[i].win AS win, l[1:i] AS l, list_sort(list_transform(l[1:i], lambda x: {'k': -x.p, 'win': x.win, 'mid': x.mid, 'cm': x.cm}))[1] AS b FROM ix)
 SELECT symbol, n, win, up, f32(1 - list_product(list_transform(l, lambda x: 1 - x.p))) AS p_any, list_max(list_transform(l, lambda x: x.formed)) AS formed_any, list_max(list_transform(l, lambda x: x.reached)) AS reached_any,
 f32(CASE WHEN up THEN list_max(list_transform(l, lambda x: x.cm)) ELSE list_min(list_transform(l, lambda x: x.cm)) END) AS furthest, b.win::INT AS best_window, f32(b.mid) AS best_median, f32(b.cm) AS best_centre FROM cu""")
def o205_cumulative_moves(spark, d):
    c = moves.cumulative(chances(spark, d), ["symbol", "n", "up"], "win")
    return rounded(c.select("symbol", "n", "win", "up", "p_any", "formed_any", "reached_any", "furthest", "best_window", "best_median", "best_centre"))


@query(FORECASTS + f""", b AS (SELECT symbol, date, (day_idx % 30)::INT AS minute, actual AS price, actual / 2 AS vwap, CASE WHEN day_idx % 30 < 15 THEN q ELSE list_transform(q, lambda x: x + actual / 4) END AS q FROM fc)
 SELECT symbol, date, minute, CASE WHEN minute < 15 THEN 930 ELSE 945 END AS stage, f32(q[3]) AS mid, f32(q[4] - q[2]) AS spread, f32(CASE WHEN price < q[1] THEN 0.025 WHEN price > q[5] THEN 0.975 ELSE {cdf("price")} END) AS band_price, f32(CASE WHEN vwap < q[1] THEN 0.025 WHEN vwap > q[5] THEN 0.975 ELSE {cdf("vwap")} END) AS band_vwap FROM b""")
def o138_band_position(spark, d):
    late = F.transform("q", lambda x: x + F.col("actual") / 4)
    rows = forecasts(spark, d).select("symbol", "date", (F.col("day_idx") % 30).cast("int").alias("minute"), F.col("q").alias("q_early"), late.alias("q_late"), F.col("actual").alias("price"), (F.col("actual") / 2).alias("vwap"))
    return rounded(moves.band_position(rows, TAUS).select("symbol", "date", "minute", "stage", "mid", "spread", "band_price", "band_vwap"))


_RATIOS = {"file / regular": ("g_volume", "regular_volume"), "file / all": ("g_volume", "all_volume"), "before / regular": ("pre_volume", "regular_volume"), "after / regular": ("after_volume", "regular_volume")}
_MATCHES = {"open": ("g_open", "regular_first"), "close": ("g_close", "regular_last"), "last before": ("last_before_565", "pre_last")}


@query(PRINTS + """, g AS (SELECT symbol, date, sum(volume) AS g_volume, arg_min(price, (minute, seq)) AS g_open, arg_max(price, (minute, seq)) AS g_close FROM pr WHERE minute >= 570 AND minute < 960 GROUP BY ALL), al AS (SELECT symbol, date, sum(volume) AS all_volume FROM pr GROUP BY ALL)
 , j AS (SELECT * FROM parts LEFT JOIN g USING (symbol, date) LEFT JOIN al USING (symbol, date)), l AS (""" + " UNION ALL ".join(
    [f"SELECT symbol, '{k}' AS pair, round(CASE WHEN {a} <> 0 THEN {a} / nullif({b}, 0) END, 4) AS value, NULL::INT AS hit FROM j" for k, (a, b) in _RATIOS.items()]
    + [f"SELECT symbol, '{k}', NULL, (abs({a} - {b}) <= 0.005 * greatest(abs({b}), 1e-9))::INT FROM j" for k, (a, b) in _MATCHES.items()]
) + ") SELECT symbol, pair, count(*) AS n, f32(median(value)) AS median, f32(min(value)) AS least, f32(max(value)) AS largest, sum(hit)::BIGINT AS hits FROM l WHERE value IS NOT NULL OR hit IS NOT NULL GROUP BY ALL")
def o127_feed_agreement(spark, d):
    p = prints(spark, d)
    order = F.struct("minute", "seq")
    day = p.groupBy("symbol", "date").agg(F.sum("volume").alias("all_volume"))
    file = p.filter("minute >= 570 AND minute < 960").groupBy("symbol", "date").agg(F.sum("volume").alias("g_volume"), F.min_by("price", order).alias("g_open"), F.max_by("price", order).alias("g_close"))
    rows = parts(spark, d).join(file, ["symbol", "date"], "left").join(day, ["symbol", "date"], "left")
    return rounded(extended.reconcile(rows, ["symbol"], _RATIOS, _MATCHES))


def prints(spark, d):
    e = read(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.select(F.col("event_type").alias("symbol"), F.to_date("ts").alias("date"), (F.hour("ts") * 60 + F.minute("ts")).alias("minute"), F.col("value").alias("price"), (F.get_json_object("props", "$.k").cast("double") + 1).alias("volume"), F.col("event_id").alias("seq"))


PAST = 5


@query(PRINTS + f""", mi AS (SELECT symbol, date, minute, arg_max(price, seq) AS close, sum(volume) AS volume, sum(price * volume) / sum(volume) AS vwap FROM pr WHERE minute >= 570 AND minute < 960 GROUP BY ALL)
 , dv AS (SELECT symbol, date, sum(vwap * volume) / sum(volume) AS day_vwap FROM mi GROUP BY ALL), gd AS (SELECT d.symbol, d.date, d.day_vwap, g.minute::INT AS minute, mi.close, coalesce(mi.volume, 0) AS volume FROM dv d CROSS JOIN (SELECT unnest(range(570, 960)) AS minute) g LEFT JOIN mi ON mi.symbol = d.symbol AND mi.date = d.date AND mi.minute = g.minute)
 SELECT symbol, date, minute, f32(day_vwap) AS day_vwap, f32(last_value(close IGNORE NULLS) OVER (PARTITION BY symbol, date ORDER BY minute)) AS close, f32(volume) AS volume, f32(CASE WHEN count(*) OVER w = {PAST} THEN median(volume) OVER w END) AS normal_volume FROM gd WINDOW w AS (PARTITION BY symbol, minute ORDER BY date ROWS BETWEEN {PAST} PRECEDING AND 1 PRECEDING)""")
def o139b_index_minutes(spark, d):
    regular = prints(spark, d).filter("minute >= 570 AND minute < 960")
    m = regular.groupBy("symbol", "date", "minute").agg(F.max_by("price", "seq").alias("close"), F.sum("volume").alias("volume"), (F.sum(F.col("price") * F.col("volume")) / F.sum("volume")).alias("vwap"))
    return rounded(extended.index_minutes(m, PAST).select("symbol", "date", "minute", "day_vwap", "close", "volume", "normal_volume"))


@query(BARS + """, dv AS (SELECT symbol, date, sum((order_key % 7) / 100) AS dividend FROM releases GROUP BY ALL), j AS (SELECT symbol, date, open, close, coalesce(dividend, 0) AS dividend FROM bars LEFT JOIN dv USING (symbol, date))
 SELECT symbol, date, f32(dividend) AS dividend, f32(ln(open / (lag(close) OVER (PARTITION BY symbol ORDER BY date) - dividend))) AS gap FROM j""")
def o139_index_days(spark, d):
    paid = releases(spark, d).select("symbol", F.col("date").alias("ex_date"), ((F.col("order_key") % 7) / 100).alias("cash"))
    return rounded(extended.index_days(bars(spark, d).select("symbol", "date", "open", "close"), paid).select("symbol", "date", "dividend", "gap"))
