"""One job that answers every question and writes each result.

    python -m quarry.plans.run IN_DIR OUT_DIR [name ...] [--colocate N]

Relations shared by several questions (stays joined to income, daily
prices, converted prices) are computed once and kept as Parquet under the
session's checkpoint directory (``spark.checkpoint.dir``, a shared
folder on a cluster), which cuts their lineage. A lost executor then costs a
re-read of those files, not a re-run of the lineitem aggregation for every
question. Each result is written through Spark's commit protocol with the
file layout of its question (see ``Output``), then registered as a temp view
over the written files, so SQL over a result reads the result instead of
recomputing it.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from quarry.operators.wordcount import word_count
from quarry.plans import catalog as cat
from quarry.plans import prices as px
from quarry.plans import ratings as rt
from quarry.plans import retail, revenue, standins, walkthrough
from quarry.plans.roundtrip import NULL
from quarry.session import drop_kept, ensure_checkpoint_dir, kept, require_ansi
from quarry.sinks import write_bucketed, write_csv
from quarry.sources.delimited import read_delimited
from quarry.sources.tables import table


@dataclass
class Output:
    """A result and its file layout.

    ``files`` is set only for results whose size is bounded whatever the
    input (top-n, global, per-calendar-unit, per-segment or per-nation
    aggregates); everything that grows with the input is written one file
    per task, never squeezed through a few tasks or split by a hot key.
    """

    build: Callable[["Shared"], DataFrame]
    files: int | None = None
    by: tuple[str, ...] = field(default_factory=tuple)
    sort_within: tuple[str, ...] = field(default_factory=tuple)


class Shared:
    """Inputs and checkpointed shared relations of one run.

    With ``colocate`` buckets, orders and lineitem are first rewritten as
    tables bucketed by order key (under the checkpoint folder); every later
    aggregate or join on the order key then reads them without a shuffle.
    """

    def __init__(self, spark: SparkSession, data_dir: str, reliable: bool = True, colocate: int | None = None):
        self.spark, self.d = spark, data_dir
        self._reliable = reliable
        self._cache: dict[str, DataFrame] = {}
        self._colocated: dict[str, DataFrame] = {}
        if colocate:
            for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
                self._colocated[name] = colocated_table(spark, data_dir, name, key, colocate)

    def t(self, name: str) -> DataFrame:
        if name in self._colocated:
            return self._colocated[name]
        return table(self.spark, self.d, name)

    def _keep(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._cache:
            df = make()
            self._cache[name] = kept(df, name) if self._reliable else df
        return self._cache[name]

    def release(self) -> None:
        """Remove the files of the relations kept for this run."""
        drop_kept(*self._cache.values())
        self._cache.clear()

    @property
    def stays_income(self) -> DataFrame:
        """Stays left-joined to income once for all revenue questions."""
        return self._keep(
            "stays_income",
            lambda: standins.stays_with_income(self.spark, self.d, self.t("orders"), self.t("lineitem")),
        )

    @property
    def prices(self) -> DataFrame:
        return self._keep("prices", lambda: standins.prices(self.spark, self.d))

    @property
    def converted(self) -> DataFrame:
        return self._keep("converted", lambda: px.convert(self.prices, standins.rates(self.spark, self.d)))

    @property
    def ratings(self) -> DataFrame:
        return standins.ratings(self.spark, self.d)

    @property
    def user_parts(self) -> DataFrame:
        """Per-user partial state of the mean rating, shared by two questions."""
        return self._keep("user_parts", lambda: rt.rating_parts(self.ratings, "user_id"))

    @property
    def users(self) -> DataFrame:
        return standins.users(self.spark, self.d)


def colocated_table(spark: SparkSession, data_dir: str, name: str, key: str, buckets: int) -> DataFrame:
    """``name`` of ``data_dir`` as a table bucketed by ``key``, written once.

    Every call writes a copy of the files as they are now, under a name of its own; a run makes one
    and asks all its questions of it.
    """
    table_name = f"colocated_{name}_{uuid.uuid4().hex}"
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return write_bucketed(table(spark, data_dir, name), table_name, key, buckets, f"{root}/colocated/{table_name}")


def _li(s: Shared) -> DataFrame:
    return s.t("lineitem")


# Layouts follow the questions' own outputs: small results in one or two
# files, keyed results hash-partitioned on their key.
OUTPUTS: dict[str, Output] = {
    "revenue_by_country": Output(lambda s: revenue.revenue_in(s.stays_income, cat.COUNTRY)),
    "revenue_by_country_normalized": Output(
        lambda s: revenue.revenue_in(s.stays_income, cat.COUNTRY, normalize=True, drop_null=True)
    ),
    "top100_revenue": Output(lambda s: revenue.top_revenue(s.stays_income, cat.TOP_STAYS), files=2),
    "top200_city_name_revenue": Output(
        lambda s: revenue.revenue_by(s.stays_income, ("city", "name"), cat.TOP_GROUPS), files=4, by=("city",)
    ),
    "top200_name_revenue": Output(
        lambda s: revenue.revenue_by(s.stays_income, ("name",), cat.TOP_GROUPS, drop_null=True), files=1
    ),
    "city_revenue": Output(lambda s: revenue.revenue_by(s.stays_income, ("city",), cat.TOP_GROUPS), files=1),
    "no_revenue": Output(lambda s: revenue.no_revenue(s.stays_income)),
    "top_spender": Output(lambda s: retail.top_spender(s.t("orders"), "o_custkey", "o_totalprice"), files=1),
    "sold_report": Output(
        lambda s: retail.sold_report(
            _li(s), "l_partkey", s.t("part"), "p_partkey", "p_name", "l_quantity", "l_extendedprice"
        ),
    ),
    "never_sold": Output(
        lambda s: retail.never_sold(s.t("orders"), "o_orderkey", _li(s), "l_orderkey", ["o_orderkey", "o_custkey", "o_totalprice"]),
    ),
    "lines_of_top10_stock": Output(
        lambda s: retail.facts_of_top_stock(_li(s), "l_partkey", s.t("part"), "p_partkey", "p_size", cat.TOP_STOCK),
    ),
    "day_of_max_high": Output(lambda s: px.day_of_extreme(s.prices, "high", "max", "high"), files=1),
    "mean_close": Output(lambda s: px.mean_of(s.prices, "close", "mean_close"), files=1),
    "day_of_max_volume": Output(lambda s: px.day_of_extreme(s.prices, "volume", "max", "max_volume", False), files=1),
    "day_of_min_volume": Output(lambda s: px.day_of_extreme(s.prices, "volume", "min", "min_volume", False), files=1),
    "days_close_above": Output(lambda s: px.days_above(s.prices, "close", cat.CLOSE_ABOVE), files=4, by=("date",)),
    "pct_days_high_above": Output(
        lambda s: px.pct_above(s.prices, "high", cat.HIGH_ABOVE, "pct_days_high_above"), files=1
    ),
    "max_high_by_year": Output(lambda s: px.extreme_by_year(s.prices, "high", "max", "max_high"), files=1),
    "mean_close_by_month": Output(
        lambda s: px.mean_by_month(s.prices, "close", "mean_close"), files=1, sort_within=("year", "month")
    ),
    "eur_day_of_max_high": Output(lambda s: px.day_of_extreme(s.converted, "high_eur", "max", "high_eur"), files=1),
    "eur_mean_close": Output(
        lambda s: px.mean_of(s.converted, "close_eur", "mean_close_eur"), files=1
    ),
    "eur_day_of_max_volume": Output(
        lambda s: px.day_of_extreme(s.converted, "volume", "max", "max_volume", False), files=1
    ),
    "eur_day_of_min_volume": Output(
        lambda s: px.day_of_extreme(s.converted, "volume", "min", "min_volume", False), files=1
    ),
    "eur_days_close_above": Output(
        lambda s: px.days_above(s.converted, "close_eur", cat.CLOSE_ABOVE), files=3, by=("date",)
    ),
    "eur_pct_high_above": Output(
        lambda s: px.pct_above(s.converted, "high_eur", cat.HIGH_ABOVE, "pct_days_high_eur_above"), files=1
    ),
    "eur_max_high_by_year": Output(
        lambda s: px.extreme_by_year(s.converted, "high_eur", "max", "max_high_eur"), files=1
    ),
    "eur_min_high_by_year": Output(
        lambda s: px.extreme_by_year(s.converted, "high_eur", "min", "min_high_eur"), files=1
    ),
    "eur_mean_close_by_month": Output(
        lambda s: px.mean_by_month(s.converted, "close_eur", "mean_close_eur"),
        files=1,
        sort_within=("year", "month"),
    ),
    "mean_by_user": Output(lambda s: rt.mean_by_user(s.ratings, s.users, s.user_parts)),
    "mean_by_segment": Output(lambda s: rt.mean_by_segment(s.ratings, s.users, s.user_parts), files=1),
    "top10_items": Output(lambda s: rt.top_items(s.ratings, standins.items(s.spark, s.d), cat.TOP_ITEMS), files=1),
    "party_union": Output(lambda s: walkthrough.party_union(s.t("customer"), s.t("supplier"))),
    "word_count": Output(lambda s: word_count(s.t("documents"), "text")),
}

# SQL run over the registered result views after the writes.
VIEW_QUERIES = {
    "users_below_threshold": ("mean_by_user", "SELECT * FROM mean_by_user WHERE mean_rating < :t", {"t": cat.RATING_BELOW}),
}


# The other questions have no layout of their own: one file per task.
OUTPUTS |= {
    name: Output(lambda s, query=query: query(s.spark, s.d))
    for name, query in cat.QUERIES.items() if name not in OUTPUTS and name not in VIEW_QUERIES
}


def run(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    names: Iterable[str] | None = None,
    reliable: bool = True,
    colocate: int | None = None,
) -> dict[str, str]:
    """Write every selected result to ``out_dir/<name>`` (CSV with header).

    Returns name -> path. The shared relations are removed when the run ends. Results are also registered as temp views under
    their names; SQL over the views (``VIEW_QUERIES``) is written the same way.
    ``colocate`` (a bucket count) first rewrites the order-keyed fact tables
    bucketed by order key (see ``colocated_table``).
    """
    if reliable:
        ensure_checkpoint_dir(spark)
    shared = Shared(spark, in_dir, reliable=reliable, colocate=colocate)
    wanted = list(names) if names else list(OUTPUTS) + list(VIEW_QUERIES)
    if unknown := [n for n in wanted if n not in OUTPUTS and n not in VIEW_QUERIES]:
        raise ValueError(f"no such result: {', '.join(unknown)}")
    written: dict[str, str] = {}
    helpers: list[str] = []
    try:
        for name in wanted:
            if name not in OUTPUTS:
                continue
            spec = OUTPUTS[name]
            df = spec.build(shared)
            path = os.path.join(out_dir, name)
            write_csv(df, path, files=spec.files, by=spec.by, sort_within=spec.sort_within, null=NULL)
            # the view reads the written result: SQL over it never recomputes the question
            text = any(t == "string" for _, t in df.dtypes)
            read_delimited(spark, path, header=True, schema=df.schema, null=NULL, multiline=text).createOrReplaceTempView(name)
            written[name] = path
        for name in wanted:
            if name not in VIEW_QUERIES:
                continue
            view, sql, args = VIEW_QUERIES[name]
            if view not in written:
                OUTPUTS[view].build(shared).createOrReplaceTempView(view)
                helpers.append(view)
            path = os.path.join(out_dir, name)
            write_csv(spark.sql(sql, args=args), path)
            written[name] = path
    finally:
        # what only this run read goes with it: views over questions not asked for, then the shared relations
        for view in helpers:
            spark.catalog.dropTempView(view)
        shared.release()
    return written


def main(argv: list[str]) -> int:
    import argparse

    from pyspark.sql import SparkSession

    parser = argparse.ArgumentParser(prog="quarry.plans.run", description="Answer every question and write the results.")
    parser.add_argument("in_dir")
    parser.add_argument("out_dir")
    parser.add_argument("names", nargs="*", help="only these outputs (default: all)")
    parser.add_argument("--colocate", type=int, default=None, help="bucket orders and lineitem by order key first")
    args = parser.parse_args(argv[1:])
    # Under spark-submit the session (master, shuffle partitions, checkpoint
    # folder) comes from the submit configuration; nothing is forced here.
    spark = SparkSession.builder.appName("quarry-run").getOrCreate()
    require_ansi(spark)
    try:
        for name, path in run(spark, args.in_dir, args.out_dir, args.names or None, colocate=args.colocate).items():
            print(f"{name}\t{path}")
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
