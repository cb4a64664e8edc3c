"""Revenue questions over stays and their income.

``stays(id, name, city, cc)`` and ``income(id, revenue)`` with at most one
income row per id are joined once, as a left join that marks whether an
income row exists: ``stays_with_income`` gives
``(id, name, city, cc, revenue, has_income)``. Every question is a filter,
aggregate or top-n over that one relation, so a job answering all of them
joins once (the job runner checkpoints the result). On its own, a question's
``has_income`` filter rejects nulls of the right side and Catalyst turns the
left join back into an inner join.

Two readings exist of most questions; the default is the DataFrame reading
(null revenue stays in), ``drop_null`` gives the line-by-line reading (blank
revenue dropped before the join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.money import exact_sum
from quarry.functions.text import normalized
from quarry.operators.relational import top_n


def stays_with_income(stays: DataFrame, income: DataFrame) -> DataFrame:
    """Left join of stays to income, one row per stay; ``has_income`` is null when unmatched."""
    return stays.join(income.withColumn("has_income", F.lit(True)), "id", "left")


def _matched(joined: DataFrame, drop_null: bool) -> DataFrame:
    cond = F.col("has_income")
    if drop_null:
        cond = cond & F.col("revenue").isNotNull()
    return joined.filter(cond)


def revenue_in(joined: DataFrame, cc: str, normalize: bool = False, drop_null: bool = False) -> DataFrame:
    """(id, name, city, revenue) of stays with income whose country code is ``cc``.

    ``normalize`` compares trimmed and lower-cased codes. The code filter
    reaches the scan of the stays' source.
    """
    cond = normalized("cc") == cc.strip().lower() if normalize else F.col("cc") == cc
    return _matched(joined.filter(cond), drop_null).select("id", "name", "city", "revenue")


def top_revenue(joined: DataFrame, n: int = 100, drop_null: bool = False) -> DataFrame:
    """The ``n`` stays with most revenue; nulls last, ties by id."""
    return top_n(
        _matched(joined, drop_null).select("id", "name", "city", "revenue"),
        n,
        [F.desc_nulls_last("revenue")],
        ["id"],
    )


def revenue_by(
    joined: DataFrame,
    by: Sequence[str] = ("city", "name"),
    n: int | None = 200,
    drop_null: bool = False,
) -> DataFrame:
    """Total revenue per group ``by``, best ``n`` groups (all when ``n`` is None).

    The sum of a group whose revenues are all null is null and sorts last.
    The group-by shuffles partial sums only.
    """
    agg = _matched(joined, drop_null).groupBy(*by).agg(exact_sum("revenue").alias("total_revenue"))
    if n is None:
        return agg
    return top_n(agg, n, [F.desc_nulls_last("total_revenue")], list(by))


def no_revenue(joined: DataFrame) -> DataFrame:
    """(id, name, city) of stays with no income row **or** a null revenue.

    A left outer join plus a null test (see ``operators.without_value``), not
    an anti join: a stay whose income row holds null is kept too.
    """
    return joined.filter(F.col("revenue").isNull()).select("id", "name", "city")
