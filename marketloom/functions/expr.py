"""Column helpers: safe arithmetic, price units, quantile functions, rates, buckets and bitmasks.

IDs of the operator inventory are named in each docstring.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

C = Column | str


def col(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def null_if_nan(x: C) -> Column:
    """NaN becomes NULL, as every scan must do."""
    return F.when(~F.isnan(col(x)), col(x))


def ratio(a, b) -> Column:
    """a / b, NULL where b is 0."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def clip(x, low, high) -> Column:
    return F.when(col(x).isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), col(x))))


def price_unit(x, ref, sigma) -> Column:
    """O-92: ln(x / ref) / sigma within +-10."""
    return clip(ratio(F.try_divide(F.ln(ratio(x, ref)), F.lit(1.0)), sigma), -10.0, 10.0)


def log_ratio(x, n) -> Column:
    """O-92: ln((x + 1) / (n + 1))."""
    return F.ln((col(x) + 1) / (col(n) + 1))


def adjusted_price(price, factor) -> Column:
    """O-20a: a price times its split factor; no factor counts as 1."""
    return col(price) * F.coalesce(col(factor), F.lit(1.0))


def adjusted_volume(volume, factor) -> Column:
    """O-20a: a volume divided by its split factor."""
    return col(volume) / F.coalesce(col(factor), F.lit(1.0))


def cap_band(cap) -> Column:
    """O-20l: capitalisation band."""
    # Lower bounds in dollars.
    bounds = [("mega", 200e9), ("large", 10e9), ("mid", 2e9), ("small", 250e6)]
    out = F.when(col(cap).isNull(), F.lit("unknown"))
    for name, low in bounds:
        out = out.when(col(cap) >= low, F.lit(name))
    return out.otherwise(F.lit("micro"))


def coherent(open_, high, low, close) -> Column:
    """O-20i: whether a bar's prices fit together."""
    return (col(high) >= F.greatest(col(open_), col(close))) & (col(low) <= F.least(col(open_), col(close))) & (col(low) > 0)


def known(flag, x) -> Column:
    """O-20j, O-93: a value where its flag is 1, else NULL."""
    return F.when(col(flag) == 1, col(x))


# Forecast quantiles: q is an ascending array of values at the levels taus (a Python list).


def monotone(q) -> Column:
    """O-98: quantiles in ascending order."""
    return F.array_sort(col(q))


def prob_below(q, x, taus: list[float]) -> Column:
    """O-94: forecast CDF at x: linear between quantiles, clamped to the first and last level outside."""
    q, x, levels, n = col(q), col(x), F.array(*[F.lit(t) for t in taus]), len(taus)
    k = F.size(F.filter(q, lambda v: v <= x))
    low, high = F.get(q, k - 1), F.get(q, k)
    inside = F.get(levels, k - 1) + F.coalesce(ratio(x - low, high - low), F.lit(0.0)) * (F.get(levels, k) - F.get(levels, k - 1))
    return F.when(x.isNull() | q.isNull(), F.lit(None).cast("double")).when(k == 0, F.lit(taus[0])).when(k == n, F.lit(taus[-1])).otherwise(inside)


def percentile_of(q, x, taus: list[float]) -> Column:
    """O-97: place of x in its quantiles, half a step outside the outer levels."""
    q, x = col(q), col(x)
    return F.when(x < F.get(q, F.lit(0)), F.lit(taus[0] / 2)).when(x > F.get(q, F.lit(len(taus) - 1)), F.lit((1 + taus[-1]) / 2)).otherwise(prob_below(q, x, taus))


def cdf_tails(q, x, taus: list[float]) -> Column:
    """O-95: CDF with exponential tails beyond the outer quantiles; the tail's scale is the distance to the next quantile."""
    q, x, n = col(q), col(x), len(taus)
    at = lambda i: F.get(q, F.lit(i))
    scale_low, scale_high = F.greatest(at(1) - at(0), F.lit(1e-9)), F.greatest(at(n - 1) - at(n - 2), F.lit(1e-9))
    low = F.lit(taus[0]) * F.exp((x - at(0)) / scale_low)
    high = 1 - F.lit(1 - taus[-1]) * F.exp(-(x - at(n - 1)) / scale_high)
    return F.when(x < at(0), low).when(x > at(n - 1), high).otherwise(prob_below(q, x, taus))


def quantile_at(q, tau: float, taus: list[float]) -> Column:
    """O-96: the forecast's quantile at any level within the outer ones."""
    tau = min(max(tau, taus[0]), taus[-1])
    i = max(k for k, t in enumerate(taus) if t <= tau)
    at = lambda k: F.get(col(q), F.lit(k))
    if i == len(taus) - 1:
        return at(i)
    w = (tau - taus[i]) / (taus[i + 1] - taus[i])
    return at(i) * F.lit(1 - w) + at(i + 1) * F.lit(w)


def ladder(q, confidence: float, taus: list[float]) -> tuple[Column, Column]:
    """O-96: the levels that a forecast expects to stay above, and below, with a confidence."""
    return quantile_at(q, 1 - confidence, taus), quantile_at(q, confidence, taus)


def shape(q, taus: list[float]) -> dict[str, Column]:
    """O-99: median, inter-quartile range, width, skew, tail and chance of a rise."""
    at = lambda t: quantile_at(q, t, taus)
    median, spread = at(0.5), at(0.75) - at(0.25)
    width = at(taus[-1]) - at(taus[0])
    return {
        "median": median,
        "iqr": spread,
        "width": width,
        "skew": ratio(at(taus[-1]) + at(taus[0]) - 2 * median, width),
        "tail": ratio(width, spread),
        "p_up": 1 - prob_below(q, F.lit(0.0), taus),
    }


def pinball(q, actual, taus: list[float]) -> Column:
    """O-190: mean pinball loss of a row over its levels."""
    y = col(actual)
    terms = [F.greatest(F.lit(t) * (y - F.get(col(q), F.lit(i))), F.lit(t - 1) * (y - F.get(col(q), F.lit(i)))) for i, t in enumerate(taus)]
    return sum(terms[1:], terms[0]) / len(taus)


def bucket(p, edges: list[float]) -> Column:
    """O-53: index of the bucket [edge, next edge) that holds p; the top edge belongs to the last; outside -1."""
    p, eps = col(p), 1e-12
    out = F.when(p.isNull() | (p < edges[0] - eps) | (p > edges[-1] + eps), F.lit(-1))
    for i in range(len(edges) - 2):
        out = out.when(p < edges[i + 1] - eps, F.lit(i))
    return out.otherwise(F.lit(len(edges) - 2))


def wilson(hits, n, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """O-52: Wilson 95 % interval of a rate."""
    p, n = ratio(hits, n), col(n)
    middle = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    return middle - half, middle + half


def binomial_z(hits, n, expected) -> Column:
    """O-52: how many standard deviations a hit rate lies from its expected probability."""
    return ratio(ratio(hits, n) - col(expected), F.sqrt(ratio(col(expected) * (1 - col(expected)), n)))


def pack_mask(flags: list) -> Column:
    """O-105: bit i is set where flag i is true."""
    return sum((F.when(F.coalesce(col(f), F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(flags)), F.lit(0)).cast("int")


def has_bit(mask, i: int) -> Column:
    return col(mask).bitwiseAND(F.lit(1 << i)) != 0


def number(text) -> Column:
    """O-06, O-08: a number from text with thousands separators, percent or dollar signs; NULL if it is none."""
    return F.regexp_replace(col(text), r"[,%$\s]", "").try_cast("double")


def ny_time(ts) -> Column:
    """O-90: a UTC time as New York wall-clock time."""
    return F.from_utc_timestamp(col(ts), "America/New_York")


def ny_minute(ts) -> Column:
    """O-90: minute of the New York day."""
    t = ny_time(ts)
    return F.hour(t) * 60 + F.minute(t)
