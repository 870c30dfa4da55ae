"""Tolerant numeric parsing and the price-spike predicate.

Spark's ``try_cast('1d' AS DOUBLE)`` gives 1.0 where the warehouse and Python
refuse it, and Spark orders NaN above every number; both are fenced off here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numeric text accepted by SAFE_CAST / Python float(): optional sign, digits with
# an optional fraction, optional exponent, or nan/inf spellings.
NUMERIC_RE = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)\s*$"

# Spike thresholds of the guide-price guard.
SPIKE_RATIO = 3.0          # new price above ratio x prior
SPIKE_ABS_MIN = 150        # and more than this many yen above prior
SPIKE_PRIOR_MIN = 40       # a prior below 40 yen is not trusted as a baseline
BASELINE_LOOKBACK_DAYS = 30


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_double(c) -> Column:
    """``SAFE_CAST(x AS FLOAT64)``: NULL unless the whole text is a number."""
    s = _col(c).cast("string")
    return F.when(s.rlike(NUMERIC_RE), F.trim(s).try_cast("double"))


def safe_decimal(c, precision: int = 18, scale: int = 2) -> Column:
    """Money text -> exact DECIMAL (NULL unless plain decimal text).

    Sums over DECIMAL are exact, so a total does not change with the order in
    which partitions are added up.
    """
    s = _col(c).cast("string")
    return F.when(s.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"),
                  F.trim(s).try_cast(f"decimal({precision},{scale})"))


def safe_bigint(c) -> Column:
    """Python ``int(x)`` on a cell: integer text only, else NULL."""
    s = _col(c).cast("string")
    return F.when(s.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(s).try_cast("bigint"))


def comma_float(c) -> Column:
    """``float(str(x).replace(',', '').strip())`` or NULL.

    Python's ``float`` also reads full-width digits (``'１２００'`` -> 1200.0), so
    they are mapped to ASCII first; the baseline side (``safe_double``) keeps
    the warehouse cast, which does not.
    """
    s = F.regexp_replace(_col(c).cast("string"), ",", "")
    return safe_double(F.translate(s, "０１２３４５６７８９", "0123456789"))


def strip_pct_bom(c) -> Column:
    """``REPLACE(REPLACE(x,'%',''),'\\ufeff','')``."""
    return F.replace(F.replace(_col(c).cast("string"), F.lit("%"), F.lit("")),
                     F.lit("\ufeff"), F.lit(""))


def not_nan(c) -> Column:
    c = _col(c)
    return c.isNotNull() & ~F.isnan(c)


def is_spike(new, prior, ratio: float = SPIKE_RATIO, abs_min: float = SPIKE_ABS_MIN,
             prior_min: float = SPIKE_PRIOR_MIN) -> Column:
    """Both known, prior >= prior_min, new > ratio*prior and new - prior > abs_min.

    Never NULL; NaN on either side is "not a spike" (Python comparison semantics).
    """
    new, prior = _col(new), _col(prior)
    cond = (not_nan(new) & not_nan(prior) & (prior >= F.lit(prior_min))
            & (new > prior * F.lit(ratio)) & ((new - prior) > F.lit(abs_min)))
    return F.coalesce(cond, F.lit(False))


def spike_ratio(new, prior) -> Column:
    """``new / prior`` to one decimal; NULL when prior is 0 or NULL."""
    return F.round(F.try_divide(_col(new), _col(prior)), 1)


def safe_divide(a, b) -> Column:
    """``SAFE_DIVIDE``: NULL on a zero divisor."""
    return F.try_divide(_col(a), _col(b))
