"""Scalar column expressions used by the tidy, model and scoring steps.

All are compositions of built-in Spark functions so they stay inside
whole-stage codegen; none needs a Python UDF.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the results depend on (they must equal the analysis being
# rebuilt): the release year is the first "(dddd)" in a title, every such
# group is removed from the tidy title, trimming removes space, tab, CR and
# LF, and predictions are bounded to the rating scale [0.5, 5].
YEAR_PATTERN = r"\(\d{4}\)"
PAREN_PATTERN = r"[()]"
WHITESPACE_EDGES = r"^[ \t\r\n]+|[ \t\r\n]+$"
RATING_MIN = 0.5
RATING_MAX = 5.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_to_date(ts) -> Column:
    """Epoch seconds -> calendar date (session time zone is pinned to UTC)."""
    return F.to_date(F.timestamp_seconds(_c(ts)))


def release_year(title) -> Column:
    """First "(dddd)" of the title without parentheses; NULL when absent.

    ``regexp_substr`` returns NULL on no match (``regexp_extract`` would
    return the empty string), which is what the year joins expect.
    """
    return F.regexp_replace(F.regexp_substr(_c(title), F.lit(YEAR_PATTERN)), PAREN_PATTERN, "")


def trim_ws(x) -> Column:
    return F.regexp_replace(_c(x), WHITESPACE_EDGES, "")


def tidy_title(title) -> Column:
    """Title with every "(dddd)" removed, then trimmed on both sides."""
    return trim_ws(F.regexp_replace(_c(title), YEAR_PATTERN, ""))


def round_month(d) -> Column:
    """Nearest first-of-month; a date exactly half way rounds up.

    below = first of the month, above = first of the next month; the date
    moves up when it is no closer to ``below`` than to ``above``.
    """
    d = _c(d)
    below = F.trunc(d, "MM")
    above = F.add_months(below, 1)
    return F.when(F.datediff(above, d) <= F.datediff(d, below), above).otherwise(below)


def clamp(p, lo: float = RATING_MIN, hi: float = RATING_MAX) -> Column:
    """Bound a prediction to [lo, hi]; a NULL prediction stays NULL."""
    p = _c(p)
    return F.when(p < F.lit(lo), F.lit(lo)).when(p > F.lit(hi), F.lit(hi)).otherwise(p)


def residual(rating, pred) -> Column:
    return _c(rating) - _c(pred)


def param_grid(start: float, stop: float, step: float) -> list[float]:
    """Values start, start+step, ..., <= stop, each computed as start + k*step
    (no accumulated drift)."""
    n = int(math.floor((stop - start) / step + 1e-10))
    return [start + k * step for k in range(n + 1)]


def ppoints(n: int) -> list[float]:
    """Plotting positions (i - a) / (n + 1 - 2a), a = 3/8 for n <= 10 else 1/2."""
    a = 3.0 / 8.0 if n <= 10 else 0.5
    return [(i - a) / (n + 1 - 2 * a) for i in range(1, n + 1)]


def normal_quantiles(probs: list[float]) -> list[float]:
    """Standard normal quantiles of a fixed probability grid (driver-side,
    the grid is a parameter and never grows with the data)."""
    nd = NormalDist()
    return [nd.inv_cdf(p) for p in probs]


# The coefficients of algorithm AS 241 (PPND16) for the normal
# quantile, constant term first: numerator and denominator of the central
# part (|p - 0.5| <= 0.425), of the near tail and of the far tail.
AS241 = (
    ((3.3871328727963666080e0, 1.3314166789178437745e+2, 1.9715909503065514427e+3, 1.3731693765509461125e+4,
      4.5921953931549871457e+4, 6.7265770927008700853e+4, 3.3430575583588128105e+4, 2.5090809287301226727e+3),
     (1.0, 4.2313330701600911252e+1, 6.8718700749205790830e+2, 5.3941960214247511077e+3,
      2.1213794301586595867e+4, 3.9307895800092710610e+4, 2.8729085735721942674e+4, 5.2264952788528545610e+3)),
    ((1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
      1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
     (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
      1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9)),
    ((6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
      2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
     (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
      7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15)),
)


def normal_quantile(p) -> Column:
    """Standard normal quantile of a probability column (0 < p < 1)."""
    p = _c(p)

    def ratio(part, x):
        def poly(c):
            out = F.lit(c[-1])
            for k in c[-2::-1]:
                out = out * x + F.lit(k)
            return out
        return poly(part[0]) / poly(part[1])

    q = p - 0.5
    r = F.sqrt(-F.ln(F.least(p, 1 - p)))
    tail = F.when(r <= 5.0, ratio(AS241[1], r - 1.6)).otherwise(ratio(AS241[2], r - 5.0))
    return F.when(F.abs(q) <= 0.425, q * ratio(AS241[0], F.lit(0.180625) - q * q)).otherwise(F.signum(q) * tail)
