"""Exact money arithmetic on Spark columns.

Floating sums depend on the order in which rows meet, which changes with partitioning, so a mean over a thousand
executors is not reproducible to the last bit. The helpers here add each value as the decimal number it prints as
(``0.1`` is a tenth) and round once, half away from zero, after the aggregate. ``limbs`` says how a sum is kept:
two 64-bit sums of whole cents, and decimal limbs that only other values touch. Values from 10^-36 to 10^38 add up
exactly, whatever their sizes; NaN and infinities give what they give in floating sums.

Sums and means take column names and are built-in expressions whose aggregates split into partial and final steps.
A state (``exact_state``) can be stored and merged; sums, means and an order that compares exactly are read from it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions import limbs

# The decimal in which exact totals are shown, and what rounding reads.
TOTAL, PLACES = "DECIMAL(38,18)", 18
MOST_WITH_PLACES = 1e16  # doubles from here on are whole numbers


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _sql(name: str) -> str:
    if not isinstance(name, str):
        raise TypeError("give the name of a column; select expressions under a name first")
    return limbs.quoted(name)


def round_half_up(col: Column | str, digits: int = 2) -> Column:
    """Round half away from zero to ``digits`` places, as a double; 1.005 is read as it prints, so it gives 1.01.

    Numbers without places, NaN and infinities stay as they are.
    """
    c = _c(col)
    printed = F.round(c.cast("string").try_cast("decimal(38,20)"), digits).cast("double")
    return F.when(F.abs(c) < F.lit(MOST_WITH_PLACES), F.coalesce(printed, c.cast("double"))).otherwise(c.cast("double"))


def exact_state(name: str) -> Column:
    """Aggregate: the exact sum of a column as a struct that can be stored and merged."""
    return F.expr(limbs.struct(limbs.add(_sql(name))))


def merged_state(name: str) -> Column:
    """Aggregate: states added."""
    return F.expr(limbs.struct(limbs.merge(_sql(name))))


def state_sum(name: str) -> Column:
    """The double nearest to the sum of a state; null when nothing was added."""
    return F.expr(limbs.as_double(_sql(name)))


def state_text(name: str) -> Column:
    """All digits of the sum of a state."""
    return F.expr(limbs.as_text(_sql(name)))


def state_rounded(name: str, digits: int = 2) -> Column:
    """The sum of a state, rounded half away from zero, as a double."""
    return F.expr(limbs.rounded(_sql(name), digits))


def state_order(name: str) -> Column:
    """What states are compared by: sorts as their exact sums do."""
    return F.expr(limbs.order_key(_sql(name)))


def exact_total(name: str) -> Column:
    """Exact sum as a decimal; null when every input is null; raises if it does not fit."""
    return F.expr(limbs.let("s", limbs.struct(limbs.add(_sql(name))), limbs.as_decimal("s", TOTAL, PLACES)))


def exact_sum(name: str) -> Column:
    """Exact sum, returned as the nearest double; null when every input is null."""
    return F.expr(limbs.let("s", limbs.struct(limbs.add(_sql(name))), limbs.as_double("s")))


def mean_parts(name: str) -> tuple[Column, Column]:
    """Partial state of an exact mean: (state of the sum, count of non-null)."""
    return exact_state(name), F.count(F.col(f"`{name}`"))


def mean_from_parts(state: str, n: str, digits: int = 2) -> Column:
    """Exact mean from columns of ``mean_parts`` (or merged ones), rounded half away from zero. Null for an empty group, like ``avg``."""
    return F.expr(limbs.mean(_sql(state), _sql(n), digits))


def exact_mean(name: str, digits: int = 2) -> Column:
    """Mean of a column rounded half up to ``digits`` places, order-independent."""
    v = _sql(name)
    return F.expr(limbs.let("s", limbs.struct(limbs.add(v) | {"n": f"count({v})"}), limbs.mean("s", "s.n", digits)))


def share_pct(cond: Column, digits: int = 2) -> Column:
    """Percentage of **all** rows for which ``cond`` is true, rounded half up.

    Rows where ``cond`` is null count in the denominator but not the numerator.
    One aggregate, one pass; null on an empty input instead of a division error.
    """
    hits = F.count_if(cond)
    n = F.count(F.lit(1))
    scale = 10 ** (digits + 2)
    q = F.call_function("div", hits * (2 * scale) + n, n * 2)
    return F.when(n > 0, q / F.lit(10**digits))
