"""Queries of the feature registry over dense steps, and of the table functions."""

from pyspark.sql import functions as F

from marketloom.operators import kernels, registry
from marketloom.plans.base import query, rounded
from marketloom.plans.intraday import POLLS, dense, polls
from marketloom.plans.library import STEPS, stepped

FEATURES = registry.decision_features(STEPS)
_W = {"last": lambda k: f"(PARTITION BY symbol, date ORDER BY step ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)", "sf": "(PARTITION BY symbol, date ORDER BY step ROWS UNBOUNDED PRECEDING)", "af": "(PARTITION BY symbol, date ORDER BY step ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"}
_O = "(PARTITION BY symbol, date ORDER BY step)"
_FIRST = {f"ret_{k}": f"lnp(close / lag(close, {k}) OVER {_O})" for k in (1, 2, 3, 6, 12)}
for _k in (3, 6, 12):
    _w = _W["last"](_k)
    _FIRST |= {f"range_{_k}": f"(max(high) OVER {_w} - min(low) OVER {_w}) / nullif(close, 0)", f"volume_{_k}": f"sum(volume) OVER {_w}", f"vwap_gap_{_k}": f"close / nullif(sum(vwap * volume) OVER {_w} / nullif(sum(volume) OVER {_w}, 0), 0) - 1"}
_FIRST |= {"day_ret": f"lnp(close / first_value(close) OVER {_W['sf']})", "day_volume": f"sum(volume) OVER {_W['sf']}", "day_vwap_gap": f"close / nullif(sum(vwap * volume) OVER {_W['sf']} / nullif(sum(volume) OVER {_W['sf']}, 0), 0) - 1", "day_high": f"max(high) OVER {_W['sf']}", "day_low": f"min(low) OVER {_W['sf']}", "n_steps": f"count(*) OVER {_W['sf']}"}
_FIRST |= {"to_close": f"{STEPS - 1} - step", "clock_sin": f"sin(step * {2 * 3.141592653589793 / STEPS!r}::DOUBLE)", "clock_cos": f"cos(step * {2 * 3.141592653589793 / STEPS!r}::DOUBLE)"} | {f"fwd_{k}": f"lnp(lead(close, {k}) OVER {_O} / close)" for k in (1, 3, 6)}
_FIRST |= {"fwd_close": "lnp(last_value(close) OVER (PARTITION BY symbol, date ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) / close)", "most_up": f"lnp(max(high) OVER {_W['af']} / close)", "most_down": f"lnp(min(low) OVER {_W['af']} / close)"}
_SECOND = {}
for _k in (3, 6, 12):
    _w = _W["last"](_k)
    _SECOND |= {f"rv_{_k}": f"sqrt(sum(ret_1 * ret_1) OVER {_w})", f"up_{_k}": f"avg((ret_1 > 0)::INT) OVER {_w}", f"volume_share_{_k}": f"volume_{_k} / nullif(day_volume, 0)"}
_SECOND |= {"in_range": "(close - day_low) / nullif(day_high - day_low, 0)", "day_range": "(day_high - day_low) / nullif(close, 0)", "day_rv": f"sqrt(sum(ret_1 * ret_1) OVER {_W['sf']})", "day_up": f"avg((ret_1 > 0)::INT) OVER {_W['sf']}"}
_SECOND |= {f"since_{e}": f"step - last_value(CASE WHEN {e} = day_{e} THEN step END IGNORE NULLS) OVER {_W['sf']}" for e in ("high", "low")}
_THIRD = {f"z_ret_{k}": f"ret_{k} / nullif(rv_12, 0)" for k in (1, 3, 6)}
_SQL = POLLS + ", dn AS (SELECT *, (date_part('hour', minute) * 2 + date_part('minute', minute) // 30)::INT AS step FROM dense)" + "".join(
    f", {to} AS (SELECT *, {', '.join(f'{v} AS {k}' for k, v in part.items())} FROM {source})" for source, to, part in (("dn", "f1", _FIRST), ("f1", "f2", _SECOND), ("f2", "f3", _THIRD))
) + ", f4 AS (SELECT *, CASE WHEN n_steps < 3 THEN 'early' WHEN coalesce(volume_3, 0) <= 0 THEN 'no volume' WHEN abs(ret_1) > 0.5 THEN 'jump' WHEN fwd_1 IS NULL THEN 'last step' END AS reason FROM f3)"
_LONG = {"n_steps", "to_close", "since_high", "since_low"}


@query(_SQL + " SELECT symbol, date, step, " + ", ".join(f"{n}::BIGINT AS {n}" if n in _LONG else f"f32({n}) AS {n}" for n in FEATURES.features) + " FROM f4 WHERE reason IS NULL")
def o134_o241_decision_panel(spark, d):
    """All registered features of the decision rows that are kept."""
    out = FEATURES.compiled(stepped(spark, d), ("symbol", "date"), "step").filter(registry.drop_reason().isNull())
    return rounded(out.select("symbol", "date", "step", *[F.col(n).cast("long").alias(n) if n in _LONG else n for n in FEATURES.features]))


@query(_SQL + " SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM f4 GROUP BY 1")
def o134_drop_counts(spark, d):
    out = FEATURES.compiled(stepped(spark, d), ("symbol", "date"), "step", ["n_steps", "volume_3", "ret_1", "fwd_1"])
    return out.groupBy(F.coalesce(registry.drop_reason(), F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query()
def o244_zigzag_table(spark, d):
    """The table function called from SQL; tested against the fold."""
    kernels.register(spark)
    dense(spark, d).select("symbol", "date", F.col("minute").alias("at"), F.col("close").alias("price")).createOrReplaceTempView("o244_steps")
    return rounded(spark.sql("SELECT * FROM zigzag_legs(TABLE(o244_steps) PARTITION BY (symbol, date) ORDER BY (at), 0.3D)"))


@query()
def o244_value_area_table(spark, d):
    """The table function called from SQL; tested against the fold."""
    kernels.register(spark)
    polls(spark, d).select("symbol", "date", F.floor("price").cast("int").alias("bin"), "volume").createOrReplaceTempView("o244_polls")
    return rounded(spark.sql("SELECT * FROM value_area_of(TABLE(o244_polls) PARTITION BY (symbol, date), 0.7D)"))
