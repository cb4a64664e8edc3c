"""Independent SQL for every registered question, in DuckDB's dialect.

The tables are views over the same Parquet files. Money follows the same
exact rules as ``quarry.functions.money`` (every double is the decimal it prints as; sums
at 18 places; one rounding, half away from zero, after the aggregate), written out in
plain SQL so the two engines share no code.
"""

from __future__ import annotations

from quarry.plans import catalog as cat
from quarry.plans.walkthrough import STATUS_ROWS

WORD_SPLIT = r"[ \t\n\r\f]+"


def _dec(x: str) -> str:
    """A double as the decimal it prints as."""
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18))"


def _dbl(x: str) -> str:
    return f"CAST(CAST({x} AS VARCHAR) AS DOUBLE)"


def _sum(x: str) -> str:
    return _dbl(f"SUM({_dec(x)})")


def _round(x: str) -> str:
    return _dbl(f"ROUND({_dec(x)}, 2)")


def _parts(x: str) -> tuple[str, str]:
    return f"SUM({_dec(x)})", f"COUNT({x})"


def _final(s: str, n: str) -> str:
    """Half away from zero at two places, in whole numbers of 1e-18."""
    u = f"CAST(REPLACE(CAST({s} AS VARCHAR), '.', '') AS HUGEINT)"
    f = f"CAST({10**16} AS HUGEINT)"
    return f"CASE WHEN {n} > 0 THEN CAST(SIGN({s}) * ((2 * ABS({u}) + {n} * {f}) // (2 * {n} * {f})) AS DOUBLE) / 100 END"


def _mean(x: str) -> str:
    return _final(*_parts(x))


def _share(cond: str) -> str:
    return (
        f"CASE WHEN COUNT(*) > 0 THEN CAST((COUNT(*) FILTER (WHERE {cond}) * 20000 + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 100 END"
    )


STAYS = """stays AS (
  SELECT o.o_orderkey AS id, c.c_name AS name, n.n_name AS city, o.o_orderstatus AS cc
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

INCOME = f"""income AS (
  SELECT l_orderkey AS id, {_sum("CASE WHEN l_returnflag = 'R' THEN l_extendedprice END")} AS revenue
  FROM lineitem GROUP BY l_orderkey)"""

PRICES = """prices AS (
  SELECT CAST(o_orderdate AS DATE) AS date,
         arg_min(o_totalprice, o_orderkey) AS open, MAX(o_totalprice) AS high,
         MIN(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close, COUNT(*) AS volume
  FROM orders GROUP BY CAST(o_orderdate AS DATE))"""

RATES = """rates AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
         CAST(1 AS DOUBLE) - MAX(l_tax) AS open_rate,
         MAX(CAST(1 AS DOUBLE) - l_discount) AS high_rate,
         MIN(CAST(1 AS DOUBLE) - l_discount) AS low_rate
  FROM lineitem GROUP BY CAST(l_shipdate AS DATE))"""

CONVERTED = f"""{PRICES}, {RATES}, converted AS (
  SELECT p.date, p.open, p.high, p.low, p.close, p.volume, r.open_rate, r.high_rate, r.low_rate,
         p.open * r.open_rate AS open_eur, p.high * r.high_rate AS high_eur,
         p.low * r.low_rate AS low_eur, p.close * r.open_rate AS close_eur
  FROM prices p JOIN rates r ON p.date = r.date)"""

RATINGS = """ratings AS (
  SELECT user_id, CAST(json_extract(props, '$.k') AS INTEGER) AS item_id, value AS rating FROM events)"""


def _rev(select: str) -> str:
    return f"WITH {STAYS}, {INCOME}\n{select}"


def _px(select: str) -> str:
    return f"WITH {PRICES}\n{select}"


def _eur(select: str) -> str:
    return f"WITH {CONVERTED}\n{select}"


def _parts_by(key: str) -> str:
    s, n = _parts("rating")
    return f"{RATINGS}, parts AS (SELECT {key}, {s} AS s, {n} AS n FROM ratings GROUP BY {key})"


def _extreme(rel: str, col: str, how: str, out: str, rounded: bool) -> str:
    val = _round(col) if rounded else col
    return f"SELECT date, {val} AS {out} FROM {rel} WHERE {col} = (SELECT {how}({col}) FROM {rel})"


def _by_year(rel: str, col: str, how: str, out: str) -> str:
    return f"SELECT CAST(year(date) AS INTEGER) AS year, {_round(f'{how}({col})')} AS {out} FROM {rel} GROUP BY 1"


def _by_month(rel: str, col: str, out: str) -> str:
    return (
        f"SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, "
        f"{_mean(col)} AS {out} FROM {rel} GROUP BY 1, 2"
    )


_MEAN_BY_USER = (
    f"WITH {_parts_by('user_id')}\n"
    f"SELECT c.c_custkey AS user_id, {_final('p.s', 'p.n')} AS mean_rating "
    f"FROM customer c JOIN parts p ON c.c_custkey = p.user_id"
)

_CONFORM_FLAT = """SELECT CAST(c_custkey AS VARCHAR) AS datasetId, c_name AS name, CAST(c_nationkey AS VARCHAR) AS state,
       c_mktsegment AS type, c_acctbal AS geoX, CAST(c_nationkey AS DOUBLE) AS geoY,
       CAST(NULL AS VARCHAR) AS dateEnd, 'Customers' AS county,
       CAST(c_nationkey AS VARCHAR) || '_Customers_' || CAST(c_custkey AS VARCHAR) AS id
FROM customer"""

_CONFORM_NESTED = """SELECT CAST(s_suppkey AS VARCHAR) AS datasetId, s_name AS name, st AS state,
       string_split(td, ' - ')[2] AS type, geo[1] AS geoX, geo[2] AS geoY,
       CAST(NULL AS VARCHAR) AS dateEnd, 'Suppliers' AS county,
       st || '_Suppliers_' || CAST(s_suppkey AS VARCHAR) AS id
FROM (SELECT s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS st,
             CASE WHEN s_acctbal < 1000 THEN 'Supplier' ELSE 'Supplier - ' || CAST(s_nationkey AS VARCHAR) END AS td,
             CASE WHEN s_acctbal < 0 THEN [s_acctbal] ELSE [s_acctbal, CAST(s_nationkey AS DOUBLE)] END AS geo
      FROM supplier)"""

_TOP_STOCK = (
    f"SELECT l.* FROM lineitem l WHERE l.l_partkey IN "
    f"(SELECT p_partkey FROM part ORDER BY p_size DESC NULLS LAST, p_partkey LIMIT {cat.TOP_STOCK})"
)

_SOLD = f"""WITH sold AS (
  SELECT l_partkey AS k, {_sum('l_quantity')} AS items_sold, {_dbl(f"ROUND(SUM({_dec('l_extendedprice')}), 2)")} AS amount_sold
  FROM lineitem GROUP BY l_partkey)
SELECT p.p_partkey, p.p_name, s.items_sold{{amount}} FROM part p JOIN sold s ON p.p_partkey = s.k"""

def _half_even(x: str, digits: int) -> str:
    """The double's exact value in whole numbers of 2^-90, rounded with ties to even."""
    rest = f"(abs({x}) - floor(abs({x})))"
    high = f"floor({rest} * 1073741824::DOUBLE)"
    units = f"({high}::HUGEINT * 1152921504606846976::HUGEINT + floor(({rest} * 1073741824::DOUBLE - {high}) * 1152921504606846976::DOUBLE)::HUGEINT)"
    one = f"{1 << 90}::HUGEINT"
    scaled = f"({units} * {10**digits})"
    whole = f"(floor(abs({x}))::HUGEINT * {10**digits} + {scaled} // {one})"
    up = f"CASE WHEN 2 * ({scaled} % {one}) > {one} OR (2 * ({scaled} % {one}) = {one} AND {whole} % 2 = 1) THEN 1 ELSE 0 END"
    return f"CASE WHEN {x} < 0 THEN -1 ELSE 1 END * ({whole} + {up})::DOUBLE / {10**digits}"


def _half_even_share(rel: str, cond: str, out: str) -> str:
    share = f"CAST(COUNT(*) FILTER (WHERE {cond}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * CAST(100 AS DOUBLE)"
    return f"SELECT {_half_even('share', 2)} AS {out} FROM (SELECT {share} AS share FROM {rel})"


def _month_sums(where: str) -> str:
    return (
        f"SELECT strftime(l_shipdate, '%Y-%m') AS ship_month, COUNT(*) AS lines, {_sum('l_quantity')} AS quantity, "
        f"{_dbl(f'ROUND(SUM({_dec("l_extendedprice")}), 2)')} AS sales FROM lineitem WHERE {where} GROUP BY 1"
    )


def _cent_sum(remainder: int) -> str:
    return f"COALESCE(SUM(CAST(ROUND(l_extendedprice * 100) AS HUGEINT)) FILTER (WHERE l_linenumber % 3 = {remainder}), 0)"


_ALL_SIZES = f"""WITH cents AS (
  SELECT l_returnflag, {_cent_sum(0)} AS up, {_cent_sum(1)} AS mid, {_cent_sum(2)} AS down FROM lineitem GROUP BY l_returnflag
), digits AS (
  SELECT l_returnflag, CAST(up AS VARCHAR) || lpad(CAST(mid // 100 AS VARCHAR), 18, '0') || '.' || lpad(CAST(mid % 100 AS VARCHAR), 2, '0')
    || lpad(CAST(down AS VARCHAR), 18, '0') AS t FROM cents
), shown AS (
  SELECT l_returnflag, regexp_replace(ltrim(t, '0'), '[.]?0+$', '') AS digits FROM digits
)
SELECT l_returnflag, digits, CAST(digits AS DOUBLE) AS total FROM shown"""

SQL: dict[str, str] = {
    # folders per month, views, exact numbers, other readers
    "month_sales": _month_sums(f"strftime(l_shipdate, '%Y-%m') BETWEEN '{cat.FIRST_MONTH}' AND '{cat.LAST_MONTH}'"),
    "busiest_month_sales": _month_sums(
        "strftime(l_shipdate, '%Y-%m') IN (SELECT strftime(o_orderdate, '%Y-%m') AS m FROM orders "
        f"GROUP BY m ORDER BY COUNT(*) DESC, m LIMIT {cat.BUSIEST_MONTHS})"
    ),
    "spending_of_users_below": (
        f"SELECT m.user_id, m.mean_rating, s.total_spent FROM ({_MEAN_BY_USER}) m JOIN "
        f"(SELECT o_custkey, {_sum('o_totalprice')} AS total_spent FROM orders GROUP BY o_custkey) s ON m.user_id = s.o_custkey "
        f"WHERE m.mean_rating < {cat.RATING_BELOW}"
    ),
    "totals_of_all_sizes": _ALL_SIZES,
    "half_even_charges": (
        f"SELECT l_orderkey, l_linenumber, {_half_even('(l_extendedprice * (CAST(1 AS DOUBLE) - l_discount))', 2)} AS charge, "
        f"{_half_even('(l_extendedprice / 8)', 1)} AS eighth FROM lineitem"
    ),
    "inferred_comma_separated": "SELECT * FROM orders",
    "headed_lines_income": f"WITH {INCOME}\nSELECT id, revenue FROM income",
    "roundtrip_tuple_text": "SELECT * FROM events",
    "stored_schema": "SELECT * FROM part",
    # revenue
    "revenue_by_country": _rev(
        f"SELECT s.id, s.name, s.city, i.revenue FROM stays s JOIN income i ON s.id = i.id WHERE s.cc = '{cat.COUNTRY}'"
    ),
    "revenue_by_country_normalized": _rev(
        "SELECT s.id, s.name, s.city, i.revenue FROM stays s JOIN income i ON s.id = i.id "
        f"WHERE lower(trim(s.cc)) = '{cat.COUNTRY.lower()}' AND i.revenue IS NOT NULL"
    ),
    "top100_revenue": _rev(
        "SELECT s.id, s.name, s.city, i.revenue FROM stays s JOIN income i ON s.id = i.id "
        f"ORDER BY i.revenue DESC NULLS LAST, s.id LIMIT {cat.TOP_STAYS}"
    ),
    "top100_present_revenue": _rev(
        "SELECT s.id, s.name, s.city, i.revenue FROM stays s JOIN income i ON s.id = i.id "
        f"WHERE i.revenue IS NOT NULL ORDER BY i.revenue DESC, s.id LIMIT {cat.TOP_STAYS}"
    ),
    "top200_city_name_revenue": _rev(
        f"SELECT s.city, s.name, {_sum('i.revenue')} AS total_revenue FROM stays s JOIN income i ON s.id = i.id "
        f"GROUP BY s.city, s.name ORDER BY total_revenue DESC NULLS LAST, s.city, s.name LIMIT {cat.TOP_GROUPS}"
    ),
    "top200_name_revenue": _rev(
        f"SELECT s.name, {_sum('i.revenue')} AS total_revenue FROM stays s JOIN income i ON s.id = i.id "
        f"WHERE i.revenue IS NOT NULL GROUP BY s.name ORDER BY total_revenue DESC NULLS LAST, s.name LIMIT {cat.TOP_GROUPS}"
    ),
    "city_revenue": _rev(
        f"SELECT s.city, {_sum('i.revenue')} AS total_revenue FROM stays s JOIN income i ON s.id = i.id "
        f"GROUP BY s.city ORDER BY total_revenue DESC NULLS LAST, s.city LIMIT {cat.TOP_GROUPS}"
    ),
    "no_revenue": _rev(
        "SELECT s.id, s.name, s.city FROM stays s LEFT JOIN income i ON s.id = i.id WHERE i.revenue IS NULL"
    ),
    # retail
    "top_spender": (
        f"SELECT o_custkey, {_dbl(f'ROUND(SUM({_dec('o_totalprice')}), 2)')} AS total_spent FROM orders GROUP BY o_custkey "
        f"ORDER BY SUM({_dec('o_totalprice')}) DESC NULLS LAST, o_custkey LIMIT 1"
    ),
    "top_spender_unrounded": (
        f"SELECT o_custkey, {_sum('o_totalprice')} AS total_spent FROM orders GROUP BY o_custkey "
        f"ORDER BY SUM({_dec('o_totalprice')}) DESC NULLS LAST, o_custkey LIMIT 1"
    ),
    "sold_report": _SOLD.format(amount=", s.amount_sold"),
    "sold_items_only": _SOLD.format(amount=""),
    "never_sold": (
        "SELECT o_orderkey, o_custkey, o_totalprice FROM orders o "
        "WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)"
    ),
    "never_sold_outer": (
        "SELECT o.o_orderkey, o.o_custkey, o.o_totalprice FROM orders o "
        "LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) l ON o.o_orderkey = l.l_orderkey "
        "WHERE l.l_orderkey IS NULL"
    ),
    "lines_of_top10_stock": _TOP_STOCK,
    "lines_in_list": _TOP_STOCK,
    # prices
    "day_of_max_high": _px(_extreme("prices", "high", "MAX", "high", True)),
    "day_of_max_volume": _px(_extreme("prices", "volume", "MAX", "max_volume", False)),
    "day_of_min_volume": _px(_extreme("prices", "volume", "MIN", "min_volume", False)),
    "mean_close": _px(f"SELECT {_mean('close')} AS mean_close FROM prices"),
    "days_close_above": _px(f"SELECT * FROM prices WHERE close > {cat.CLOSE_ABOVE}"),
    "days_close_above_count": _px(f"SELECT COUNT(*) AS days FROM prices WHERE close > {cat.CLOSE_ABOVE}"),
    "pct_days_high_above": _px(f"SELECT {_share(f'high > {cat.HIGH_ABOVE}')} AS pct_days_high_above FROM prices"),
    "pct_days_high_above_half_even": _px(_half_even_share("prices", f"high > {cat.HIGH_ABOVE}", "pct_days_high_above")),
    "max_high_by_year": _px(_by_year("prices", "high", "MAX", "max_high")),
    "mean_close_by_month": _px(_by_month("prices", "close", "mean_close")),
    # converted prices
    "converted_prices": _eur("SELECT * FROM converted"),
    "eur_day_of_max_high": _eur(_extreme("converted", "high_eur", "MAX", "high_eur", True)),
    "eur_mean_close": _eur(f"SELECT {_mean('close_eur')} AS mean_close_eur FROM converted"),
    "eur_day_of_max_volume": _eur(_extreme("converted", "volume", "MAX", "max_volume", False)),
    "eur_day_of_min_volume": _eur(_extreme("converted", "volume", "MIN", "min_volume", False)),
    "eur_days_close_above": _eur(f"SELECT * FROM converted WHERE close_eur > {cat.CLOSE_ABOVE}"),
    "eur_pct_high_above": _eur(
        f"SELECT {_share(f'high_eur > {cat.HIGH_ABOVE}')} AS pct_days_high_eur_above FROM converted"
    ),
    "eur_pct_high_above_half_even": _eur(_half_even_share("converted", f"high_eur > {cat.HIGH_ABOVE}", "pct_days_high_eur_above")),
    "eur_max_high_by_year": _eur(_by_year("converted", "high_eur", "MAX", "max_high_eur")),
    "eur_min_high_by_year": _eur(_by_year("converted", "high_eur", "MIN", "min_high_eur")),
    "eur_mean_close_by_month": _eur(_by_month("converted", "close_eur", "mean_close_eur")),
    # ratings
    "mean_by_user": _MEAN_BY_USER,
    "mean_by_segment": (
        f"WITH {_parts_by('user_id')}\n"
        f"SELECT c.c_mktsegment AS segment, {_final('SUM(p.s)', 'SUM(p.n)')} AS mean_rating "
        "FROM customer c JOIN parts p ON c.c_custkey = p.user_id GROUP BY c.c_mktsegment"
    ),
    "top10_items": (
        f"WITH {_parts_by('item_id')}\n"
        f"SELECT pt.p_partkey AS item_id, pt.p_name AS title, {_final('p.s', 'p.n')} AS mean_rating "
        "FROM part pt JOIN parts p ON pt.p_partkey = p.item_id "
        f"ORDER BY mean_rating DESC NULLS LAST, item_id LIMIT {cat.TOP_ITEMS}"
    ),
    "users_below_threshold": f"SELECT * FROM ({_MEAN_BY_USER}) m WHERE mean_rating < {cat.RATING_BELOW}",
    # walkthrough
    "orders_by_status": (
        "SELECT s.status, s.meaning, COUNT(o.o_orderkey) AS orders FROM (VALUES "
        + ", ".join(f"('{a}', '{b}')" for a, b in STATUS_ROWS)
        + ") s(status, meaning) LEFT JOIN orders o ON o.o_orderstatus = s.status GROUP BY s.status, s.meaning"
    ),
    "full_name": "SELECT c_custkey, c_name || ', ' || CAST(c_nationkey AS VARCHAR) AS full_name FROM customer",
    "conform_flat": _CONFORM_FLAT,
    "conform_nested": _CONFORM_NESTED,
    "party_union": f"{_CONFORM_FLAT}\nUNION ALL\n{_CONFORM_NESTED}",
    "replicate_midpoint": (
        "SELECT s_suppkey, s_name, lcl, ucl, (lcl + ucl) / 2 AS avg, lcl AS lcl2, ucl AS ucl2 FROM ("
        "SELECT s_suppkey, s_name, s_acctbal AS lcl, s_acctbal + s_nationkey AS ucl, "
        "unnest(range(61)) AS copy FROM supplier) t"
    ),
    "self_union": (
        "SELECT n_nationkey, n_name, lcl, ucl, (lcl + ucl) / 2 AS avg, lcl AS lcl2, ucl AS ucl2 FROM ("
        "SELECT n_nationkey, n_name, CAST(n_regionkey AS DOUBLE) AS lcl, CAST(n_nationkey AS DOUBLE) AS ucl FROM nation "
        "UNION ALL "
        "SELECT n_nationkey, n_name, CAST(n_regionkey AS DOUBLE) AS lcl, CAST(n_nationkey AS DOUBLE) AS ucl FROM nation) t"
    ),
    "parse_delimited": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "parse_dates": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS iso_date, CAST(o_orderdate AS DATE) AS named_date FROM orders",
    "roundtrip_hash_separated": "SELECT * FROM orders",
    "roundtrip_semicolon_header": "SELECT * FROM customer",
    "roundtrip_hive_text": "SELECT * FROM part",
    "roundtrip_double_colon": "SELECT * FROM events",
    "roundtrip_nested_json": _CONFORM_NESTED,
    "word_count": (
        "SELECT word, COUNT(*) AS occurrences FROM ("
        f"SELECT unnest(regexp_split_to_array(text, '{WORD_SPLIT}')) AS word FROM documents) w "
        "WHERE word <> '' GROUP BY word"
    ),
}
