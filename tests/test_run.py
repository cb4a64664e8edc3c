import pytest
import os

from conftest import SMOKE_DIR
from quarry.plans import catalog
from quarry.plans.run import OUTPUTS, run
from quarry.sources import read_delimited


def test_run_writes_every_result_and_matches_queries(spark, scratch):
    names = ["top100_revenue", "no_revenue", "day_of_min_volume", "eur_mean_close", "mean_by_user", "users_below_threshold"]
    written = run(spark, SMOKE_DIR, scratch, names)
    assert set(written) == set(names)
    for name in names:
        path = written[name]
        assert os.path.exists(os.path.join(path, "_SUCCESS"))
        expected = catalog.QUERIES[name](spark, SMOKE_DIR)
        back = read_delimited(spark, path, header=True, schema=expected.schema)
        assert back.count() == expected.count()
        assert back.columns == expected.columns
    # results are queryable as views
    assert spark.table("top100_revenue").count() == 100


def test_every_output_is_a_registered_query():
    assert set(OUTPUTS) <= set(catalog.QUERIES)


def test_files_layout(spark, scratch):
    written = run(spark, SMOKE_DIR, scratch, ["top200_city_name_revenue", "mean_close"], reliable=False)
    parts = [f for f in os.listdir(written["mean_close"]) if f.startswith("part-")]
    assert len(parts) == 1
    parts = [f for f in os.listdir(written["top200_city_name_revenue"]) if f.startswith("part-")]
    assert 1 <= len(parts) <= 4


def test_colocated_run_joins_orders_and_income_without_shuffling_them(spark, scratch):
    from quarry.plans.run import Shared
    from quarry.plans import catalog as cat
    from quarry.plans import revenue

    s = Shared(spark, SMOKE_DIR, reliable=False, colocate=4)
    joined = s.stays_income
    plan = joined._jdf.queryExecution().executedPlan().toString()
    # neither fact table is shuffled on the order key: the scans are bucketed
    assert "Exchange hashpartitioning(l_orderkey" not in plan
    assert "Exchange hashpartitioning(id" not in plan and "Exchange hashpartitioning(o_orderkey" not in plan
    assert "Bucketed: true" in plan
    got = revenue.revenue_in(joined, cat.COUNTRY)
    want = cat.q_revenue_by_country(spark, SMOKE_DIR)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    written = run(spark, SMOKE_DIR, scratch, ["never_sold", "no_revenue"], colocate=4)
    assert set(written) == {"never_sold", "no_revenue"}


def test_only_bounded_results_get_a_file_bound():
    growing = {
        "revenue_by_country", "revenue_by_country_normalized", "no_revenue", "sold_report", "never_sold",
        "lines_of_top10_stock", "mean_by_user", "party_union", "word_count",
    }
    for name in growing:
        assert OUTPUTS[name].files is None and not OUTPUTS[name].by, name


def test_sorted_result_keeps_its_order_in_one_file(spark, scratch):
    written = run(spark, SMOKE_DIR, scratch, ["mean_close_by_month"], reliable=False)
    parts = sorted(f for f in os.listdir(written["mean_close_by_month"]) if f.startswith("part-"))
    assert len(parts) == 1
    lines = open(os.path.join(written["mean_close_by_month"], parts[0])).read().splitlines()[1:]
    keys = [tuple(int(x) for x in line.split(",")[:2]) for line in lines]
    assert keys == sorted(keys) and len(keys) > 1


def test_colocated_tables_hold_the_files_of_now(spark, scratch):
    from quarry.plans.run import colocated_table
    from quarry.sources.tables import table

    orders = table(spark, SMOKE_DIR, "orders")
    orders.write.parquet(f"{scratch}/orders.parquet")
    a = colocated_table(spark, scratch, "orders", "o_orderkey", 3).count()
    orders.write.mode("append").parquet(f"{scratch}/orders.parquet")
    assert colocated_table(spark, scratch, "orders", "o_orderkey", 3).count() == 2 * a


def test_every_question_has_an_output():
    from quarry.plans.catalog import QUERIES
    from quarry.plans.run import OUTPUTS, VIEW_QUERIES

    assert set(OUTPUTS) | set(VIEW_QUERIES) == set(QUERIES)


def test_unknown_results_are_refused(spark, scratch):
    with pytest.raises(ValueError, match="no_such"):
        run(spark, SMOKE_DIR, scratch, ["lines_in_list", "no_such"], reliable=False)
    assert not os.path.exists(os.path.join(scratch, "lines_in_list"))


def test_results_without_a_layout_are_written(spark, scratch):
    written = run(spark, SMOKE_DIR, scratch, ["lines_in_list", "conform_nested"], reliable=False)
    assert spark.table("lines_in_list").count() > 0 and set(written) == {"lines_in_list", "conform_nested"}


def test_a_run_leaves_no_shared_relation_and_no_helper_view(spark, scratch):
    from quarry.session import ensure_checkpoint_dir

    kept_dir = os.path.join(ensure_checkpoint_dir(spark).replace("file:", ""), "kept")
    before = set(os.listdir(kept_dir)) if os.path.exists(kept_dir) else set()
    spark.catalog.dropTempView("mean_by_user")
    written = run(spark, SMOKE_DIR, scratch, ["no_revenue", "eur_mean_close", "users_below_threshold"])
    assert set(written) == {"no_revenue", "eur_mean_close", "users_below_threshold"}
    assert set(os.listdir(kept_dir)) == before
    assert "mean_by_user" not in {t.name for t in spark.catalog.listTables()}
