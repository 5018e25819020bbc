"""Queries of the intraday library: moments of every step, searched in boxes, and the pockets of what followed."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.operators import library as L
from marketloom.operators import pockets as P
from marketloom.plans.base import query, rounded
from marketloom.plans.intraday import POLLS, dense
from marketloom.staging import written

STEPS, FIRST, LAST, BACK, WARM = 48, 12, 36, 2, 8
PARAMS = list(L.PARAMETERS)
CHOSEN, DIAL, WINDOW, APART = PARAMS[:5], 1.2, 20, 6

_SIGMAS = {"vwap_vs_prev": "vws / prev", "open_vs_prev": "open / prev", "move_since_open": "now / open", "path": "now / back", "from_high": "now / high", "from_low": "now / low", "rod": "rest / now", "bul": "top / now", "sag": "bottom / now"}
_OF = {p: f"lnp({_SIGMAS[p]}) / sigma" for p in _SIGMAS} | {f"day_{i}": f"d{i} / sigma" for i in (1, 2, 3)} | {"rvol": "lnp(cv / nullif(nv * curve, 0))"}
ALL = [*PARAMS, *L.READINGS]
MOMENTS = POLLS + f""", dn AS (SELECT *, (date_part('hour', minute) * 2 + date_part('minute', minute) // 30)::INT AS step FROM dense)
, dd AS (SELECT symbol, date, arg_min(coalesce(open, close), (minute, vwap)) AS open, sum(vwap * volume) / nullif(sum(volume), 0) AS vwap, sum(volume) AS volume FROM dn GROUP BY ALL)
, dm AS (SELECT *, lag(vwap) OVER w AS prev, lnp(vwap / lag(vwap) OVER w) AS d0 FROM dd WINDOW w AS (PARTITION BY symbol ORDER BY date))
, dy AS (SELECT symbol, date, open, prev, lag(d0, 1) OVER w AS d1, lag(d0, 2) OVER w AS d2, lag(d0, 3) OVER w AS d3, CASE WHEN count(d0) OVER p >= 5 THEN stddev_samp(d0) OVER p END AS sigma, CASE WHEN count(d0) OVER p >= 5 THEN avg(volume) OVER p END AS nv
  FROM dm WINDOW w AS (PARTITION BY symbol ORDER BY date), p AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))
, ss AS (SELECT date, row_number() OVER (ORDER BY date)::INT AS sess FROM (SELECT DISTINCT date FROM dn))
, cu AS (SELECT step, avg(share) AS curve FROM (SELECT step, sum(volume) OVER (PARTITION BY symbol, date ORDER BY step) / nullif(sum(volume) OVER (PARTITION BY symbol, date), 0) AS share FROM dn JOIN ss USING (date) WHERE sess <= {WARM}) GROUP BY step)
, ly AS (SELECT symbol, date, step, close AS now, coalesce(lag(close, {BACK}) OVER o, first_value(close) OVER o) AS back, sum(vwap * volume) OVER u / nullif(sum(volume) OVER u, 0) AS vws, min(low) OVER u AS low, max(high) OVER u AS high, sum(volume) OVER u AS cv,
  sum(vwap * volume) OVER a / nullif(sum(volume) OVER a, 0) AS rest, max(high) OVER a AS top, min(low) OVER a AS bottom FROM dn WINDOW o AS (PARTITION BY symbol, date ORDER BY step), u AS (PARTITION BY symbol, date ORDER BY step ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY symbol, date ORDER BY step ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
, mo AS (SELECT * FROM (SELECT symbol, date, sess, step, now, sigma, nv, {", ".join(f"{_OF[p]} AS {p}" for p in ALL)} FROM ly JOIN dy USING (symbol, date) JOIN cu USING (step) JOIN ss USING (date) WHERE step BETWEEN {FIRST} AND {LAST} AND sigma > 0 AND sess > {WARM})
  WHERE {" AND ".join(f"{p} IS NOT NULL" for p in ALL)})"""

_ASKED = "((date - DATE '1970-01-01') * 48 + step) % 100 = 0"


def _found(asked: str = "") -> str:
    """Matches of the moments that meet a condition on q, of all moments without one."""
    return MOMENTS + f""", sp AS (SELECT {", ".join(f"coalesce(nullif((quantile_cont({p}, 0.75) - quantile_cont({p}, 0.25)) / 1.349, 0), 1) * {DIAL} AS t_{p}" for p in CHOSEN)} FROM mo)
, fd AS (SELECT q.symbol AS q_symbol, q.date AS q_date, q.step AS q_step, m.symbol AS m_symbol, m.date AS m_date, m.step AS m_step, {" * ".join(f"(1 - power(abs(m.{p} - q.{p}) / t_{p}, 2))" for p in CHOSEN)} AS w FROM mo q, mo m, sp
  WHERE {asked} m.sess < q.sess AND m.sess >= q.sess - {WINDOW} AND abs(m.step - q.step) <= {APART} AND {" AND ".join(f"abs(m.{p} - q.{p}) / t_{p} < 1" for p in CHOSEN)})"""


FOUND = _found(_ASKED.replace("date -", "q.date -").replace("+ step", "+ q.step") + " AND")

_X = f"least(floor(log2(s.step - m.step) / {P.math.log2(STEPS + 1)!r} * {P.NX}), {P.NX - 1})::INT"
_Y = f"least(greatest(floor((lnp(s.vwap / m.now) / m.sigma + {P.YL}) / {2 * P.YL} * {P.NY}), 0), {P.NY - 1})::INT"
_MIRROR = "CASE WHEN {0} < 0 THEN -({0}) - 1 WHEN {0} >= {1} THEN {2} - ({0}) ELSE {0} END"
_R = len(P.kernel()) // 2
_BY = "q_symbol, q_date, q_step"


def _pass(source: str, target: str, axis: str, n: int) -> str:
    at = _MIRROR.format(f"c.{axis} + k.j", n, 2 * n - 1)
    other = "y" if axis == "x" else "x"
    return f", {target} AS (SELECT q.*, c.x, c.y, sum(k.w * coalesce(g.v, 0)) AS v FROM (SELECT DISTINCT {_BY} FROM g0) q, cl c, kn k LEFT JOIN {source} g ON g.q_symbol = q.q_symbol AND g.q_date = q.q_date AND g.q_step = q.q_step AND g.{axis} = {at} AND g.{other} = c.{other} GROUP BY ALL)"


POCKETS = _found() + f""", mc AS (SELECT m.symbol, m.date, m.step, {_X} AS x, {_Y} AS y, sum(s.volume / m.nv) AS mass FROM mo m JOIN dn s ON s.symbol = m.symbol AND s.date = m.date AND s.step > m.step AND s.volume > 0 GROUP BY ALL)
, g0 AS (SELECT {_BY}, x, y, sum(w * mass) AS v FROM fd JOIN mc ON mc.symbol = m_symbol AND mc.date = m_date AND mc.step = m_step GROUP BY ALL)
, cl AS (SELECT x::INT AS x, y::INT AS y FROM (SELECT unnest(range({P.NX})) AS x), (SELECT unnest(range({P.NY})) AS y)), kn AS (SELECT * FROM (VALUES {", ".join(f"({i - _R}, {w!r}::DOUBLE)" for i, w in enumerate(P.kernel()))}) v(j, w))
{_pass("g0", "g1", "x", P.NX)}{_pass("g1", "g2", "y", P.NY)}
, dq AS (SELECT {_BY}, x, y, (v + {P.FLOOR}) / sum(v + {P.FLOOR}) OVER (PARTITION BY {_BY}) AS q FROM g2)
, lv AS (SELECT {_BY}, {", ".join(f"max(q) FILTER (WHERE c >= {s}) AS l{i}" for i, s in enumerate(P.LEVELS))} FROM (SELECT *, sum(q) OVER (PARTITION BY {_BY} ORDER BY q DESC, x, y ROWS UNBOUNDED PRECEDING) AS c FROM dq) GROUP BY ALL)"""


def stepped(spark, d):
    return dense(spark, d).withColumn("step", (F.hour("minute") * 2 + F.floor(F.minute("minute") / 30)).cast("int"))


def library(spark, d):
    """(moments, minutes): a written table of all moments after the first WARM sessions, and the dense steps."""
    m = written(stepped(spark, d), "library-steps")
    sess = m.select("date").distinct().withColumn("sess", F.row_number().over(Window.orderBy("date")))  # the calendar
    day = Window.partitionBy("symbol", "date")
    share = F.sum("volume").over(day.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)) / F.nullif(F.sum("volume").over(day), F.lit(0))
    curve = m.join(F.broadcast(sess), "date").filter(F.col("sess") <= WARM).select("step", share.alias("share")).groupBy("step").agg(F.avg("share").alias("curve"))
    laid = L.laid_out(m, L.stock_days(m), curve, FIRST, LAST, BACK)
    return written(L.moments(laid, sess.filter(F.col("sess") > WARM)), "library-moments"), m


def asked(lib):
    return lib.filter((F.datediff("date", F.lit("1970-01-01").cast("date")) * 48 + F.col("step")) % 100 == 0)


def leveled(spark, d):
    """(density and levels of each moment that has matches, own cells of each moment)."""
    lib, minutes = library(spark, d)
    found = L.search(lib, lib, CHOSEN, DIAL, WINDOW, APART)
    cells = written(P.moment_cells(lib, minutes, STEPS), "library-cells")
    return written(P.levels(P.densities(P.grids(found, cells))), "library-pockets"), cells


@query(MOMENTS + f" SELECT symbol, date, step, {', '.join(f'f32({p}) AS {p}' for p in ALL)} FROM mo")
def o171_library_moments(spark, d):
    return rounded(library(spark, d)[0].select("symbol", "date", "step", *ALL))


@query(FOUND + " SELECT q_symbol, q_date, q_step, m_symbol, m_date, m_step, f32(w) AS w FROM fd")
def o172_o173_box_matches(spark, d):
    """Moments whose (day, step) number is divisible by 100, searched in all earlier moments by the cell tree."""
    lib, _ = library(spark, d)
    return rounded(L.search(asked(lib), lib, CHOSEN, DIAL, WINDOW, APART))


@query(POCKETS + " SELECT q_symbol, q_date, q_step, x, y, f32(q) AS q FROM dq")
def o174_o175_pocket_maps(spark, d):
    out = leveled(spark, d)[0].select(*P.QUERY, F.posexplode("q").alias("i", "q"))
    return rounded(out.select(*P.QUERY, F.floor(F.col("i") / P.NY).cast("int").alias("x"), (F.col("i") % P.NY).alias("y"), "q"))


@query(POCKETS + f""", mk AS (SELECT {_BY}, x * 32 + y AS c FROM dq JOIN lv USING ({_BY}) WHERE q >= l0)
, rc AS (SELECT * FROM (WITH RECURSIVE re AS (SELECT {_BY}, c AS s, c FROM mk UNION SELECT re.q_symbol, re.q_date, re.q_step, re.s, n.c FROM re JOIN mk n USING ({_BY}) WHERE abs(n.c // 32 - re.c // 32) + abs(n.c % 32 - re.c % 32) = 1) SELECT * FROM re))
 SELECT {_BY}, count(DISTINCT root) AS n_blobs, count(*) AS n_cells FROM (SELECT {_BY}, c, min(s) AS root FROM rc GROUP BY ALL) GROUP BY ALL""")
def o177_pocket_blobs(spark, d):
    """Separate blobs of the pockets that hold half of the later volume."""
    return P.blobs(P.marked(leveled(spark, d)[0], 0), P.QUERY, P.NY)


@query(POCKETS + f""", sc AS (SELECT {_BY}, mass, q, l0, l1, l2 FROM dq JOIN lv USING ({_BY}) JOIN mc ON mc.symbol = q_symbol AND mc.date = q_date AND mc.step = q_step AND mc.x = dq.x AND mc.y = dq.y)
 SELECT {_BY}, {", ".join(f"f32(sum(mass * (q >= l{i})::INT) / sum(mass)) AS cover_{int(100 * s)}" for i, s in enumerate(P.LEVELS))}, f32(sum(mass * ln(q)) / sum(mass)) AS log_score FROM sc GROUP BY ALL""")
def o178_o181_pocket_scores(spark, d):
    return rounded(P.pocket_scores(*leveled(spark, d)))
