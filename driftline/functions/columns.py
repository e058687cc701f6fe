"""Column-expression building blocks (all JVM-side, codegen friendly)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the monitored system's definitions.
EPSILON = 1e-6                      # PSI clip floor and constant-feature edge width
LEVELS = ("OK", "WARN", "ALERT")    # ordinal order of signal levels
ACTIONS = ("NO_ACTION", "WATCH", "RECALIBRATE_THRESHOLD", "RETRAIN", "HALT")
SCORE_BAND_INNER_EDGES = (1e-4, 1e-3, 1e-2, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90)

INF = float("inf")


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_finite(c) -> Column:
    """NOT NULL and NOT NaN and not +/-inf."""
    x = col_(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(INF))


def nan_to_null(c) -> Column:
    """Map NaN and +/-inf to NULL (JSON-safe, and Spark's max ranks NaN highest)."""
    x = col_(c)
    return F.when(is_finite(x), x)


def drop_nan(c) -> Column:
    """NULL for NaN only; keeps +/-inf (how a NaN-ignoring mean treats values)."""
    x = col_(c)
    return F.when(~F.isnan(x), x)


def flagged(score, threshold) -> Column:
    """``score >= threshold``; NaN and NULL scores are not flagged (Spark alone
    would say NaN >= t is true)."""
    s = col_(score)
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.coalesce((s >= t) & ~F.isnan(s), F.lit(False))


def bin_index(value, inner_edges, max_inner: int) -> Column:
    """Half-open quantile bin: number of inner edges <= value.

    Written as a sum of bounded CASE terms (at most ``max_inner``) so it stays in
    whole-stage codegen; ``get`` yields NULL past the array end."""
    v = col_(value)
    e = col_(inner_edges)
    terms = [F.when(v >= F.get(e, k), 1).otherwise(0) for k in range(max_inner)]
    if not terms:
        return F.lit(0)
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def score_band(score) -> Column:
    """Index 0..9 of the fixed score bands (open at both ends)."""
    s = col_(score)
    out = F.lit(0)
    for e in SCORE_BAND_INNER_EDGES:
        out = out + F.when(s >= F.lit(e), 1).otherwise(0)
    return out


def psi_sum(actual, expected, n_bins) -> Column:
    """Sum over bins of (a - e) * ln(a / e) with both sides clipped to >= EPSILON
    (no renormalisation). NULL if ``actual`` is NULL (no finite values)."""
    a = col_(actual)
    e = col_(expected)

    def term(acc, k):
        ak = F.greatest(F.get(a, k), F.lit(EPSILON))
        ek = F.greatest(F.get(e, k), F.lit(EPSILON))
        return acc + (ak - ek) * F.ln(ak / ek)

    body = F.aggregate(F.sequence(F.lit(0), col_(n_bins) - 1), F.lit(0.0), term)
    return F.when(a.isNotNull(), body)


def classify_level(value, warn, alert, unknown: str = "UNKNOWN") -> Column:
    """Non-finite -> ``unknown``; >= alert -> ALERT; >= warn -> WARN; else OK."""
    v = col_(value)
    w = warn if isinstance(warn, Column) else F.lit(float(warn))
    a = alert if isinstance(alert, Column) else F.lit(float(alert))
    return (F.when(~is_finite(v), F.lit(unknown))
            .when(v >= a, F.lit("ALERT"))
            .when(v >= w, F.lit("WARN"))
            .otherwise(F.lit("OK")))


def level_rank(level) -> Column:
    lv = col_(level)
    return F.when(lv == "ALERT", 2).when(lv == "WARN", 1).otherwise(0)


def rank_level(rank) -> Column:
    r = col_(rank)
    return F.when(r >= 2, "ALERT").when(r == 1, "WARN").otherwise("OK")


def ks_pvalue(d, n1, n2, terms: int = 100) -> Column:
    """Two-sample KS p-value, asymptotic Kolmogorov distribution with the
    small-sample correction z' = z + 1/(6 sqrt n) + (z - 1)/(4 n),
    n = round(n1 n2 / (n1 + n2)), z = sqrt(n) D; p = 2 sum (-1)^(k-1) e^(-2 k^2 z'^2),
    clipped to [0, 1]. NULL when D is NULL."""
    dd, a, b = col_(d), col_(n1).cast("double"), col_(n2).cast("double")
    n = F.round(a * b / (a + b))
    z = F.sqrt(n) * dd
    zc = z + F.lit(1.0) / (F.lit(6.0) * F.sqrt(n)) + (z - 1) / (F.lit(4.0) * n)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(F.lit(-2.0) * k * k * zc * zc))
    p = F.least(F.greatest(F.lit(2.0) * series, F.lit(0.0)), F.lit(1.0))
    # below z' = 0.2 the survival function is 1 to 1e-10 and the series is slow
    return F.when(dd.isNotNull() & (n > 0), F.when(zc < 0.2, F.lit(1.0)).otherwise(p))


def fmt4(c) -> Column:
    """4-decimal text, or 'n/a' for NULL / non-finite."""
    x = col_(c)
    return F.when(is_finite(x), F.format_string("%.4f", x)).otherwise(F.lit("n/a"))


def round6(c) -> Column:
    return F.round(col_(c), 6)
