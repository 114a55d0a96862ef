"""Contract and validation queries (Q11-Q18) on orders: training rows
before 2000-01-01, incoming rows after, with injected missing values."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions.numeric import rnd, sql_rnd
from fathom.operators import contract
from fathom.plans.common import LI_KEY, SQL_LI_MISSING, lineitem_missing
from fathom.plans.registry import query
from fathom.sources.tables import Tables, sql_injected_missing, with_injected_missing

CUTOFF = "2000-01-01 00:00:00"
NUMS = ["o_custkey", "o_totalprice"]
TEXTS = ["o_orderstatus", "o_orderpriority", "cust_text"]
COLS = NUMS + TEXTS


def orders_contract_input(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    o = with_injected_missing(o, ["o_orderkey"], ["o_totalprice", "o_orderpriority"])
    o = o.withColumn("cust_text", F.col("o_custkey").cast("string"))
    is_train = F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz")
    return o.where(is_train), o.where(~is_train)


SQL_O = f"""o AS (SELECT o_orderkey, o_custkey, {sql_injected_missing('o_totalprice', ['o_orderkey'])} AS o_totalprice,
  o_orderstatus, {sql_injected_missing('o_orderpriority', ['o_orderkey'])} AS o_orderpriority,
  CAST(o_custkey AS VARCHAR) AS cust_text, o_orderdate FROM orders),
tr AS (SELECT * FROM o WHERE o_orderdate < TIMESTAMP '{CUTOFF}'),
inc AS (SELECT * FROM o WHERE o_orderdate >= TIMESTAMP '{CUTOFF}')"""


def _num_contract_sql(c, dtype):
    q = ", ".join(f"{sql_rnd(f'quantile_cont(CAST({c} AS DOUBLE), {p})', 4)} AS q{str(p)[2:].ljust(2, '0')}"
                  for p in contract.CONTRACT_QUANTILES)
    return (f"SELECT '{c}' AS column_name, '{dtype}' AS dtype, 'numeric' AS kind, "
            f"{sql_rnd(f'1.0e0 - count({c}) / count(*)', 6)} AS missing_rate, count(DISTINCT {c}) AS unique_values, "
            f"{sql_rnd(f'min(CAST({c} AS DOUBLE))', 4)} AS min, {sql_rnd(f'max(CAST({c} AS DOUBLE))', 4)} AS max, {q} FROM tr")


def _txt_contract_sql(c):
    nulls = ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in ["min", "max", "q01", "q05", "q50", "q95", "q99"])
    return (f"SELECT '{c}' AS column_name, 'string' AS dtype, 'categorical' AS kind, "
            f"{sql_rnd(f'1.0e0 - count({c}) / count(*)', 6)} AS missing_rate, count(DISTINCT {c}) AS unique_values, "
            f"{nulls} FROM tr")


@query("data_contract", ["Q11"], sql=f"WITH {SQL_O}\n" + "\nUNION ALL\n".join(
    [_num_contract_sql("o_custkey", "bigint"), _num_contract_sql("o_totalprice", "double")]
    + [_txt_contract_sql(c) for c in TEXTS]))
def data_contract(spark, sf_dir):
    train, _ = orders_contract_input(spark, sf_dir)
    table, _ = contract.build_contract(train.select(*COLS))
    r6 = ["missing_rate"]
    r4 = ["min", "max", "q01", "q05", "q50", "q95", "q99"]
    return table.select("column_name", "dtype", "kind", *[rnd(c, 6).alias(c) for c in r6], "unique_values",
                        *[rnd(c, 4).alias(c) for c in r4])


SQL_ALLOWED = """allowed AS (
  SELECT * FROM (
    SELECT column_name, value, count, row_number() OVER (PARTITION BY column_name ORDER BY count DESC, value) AS rank
    FROM (SELECT column_name, value, count(*) AS count FROM (
            SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value FROM tr
            UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM tr
            UNION ALL SELECT 'cust_text', cust_text FROM tr) WHERE value IS NOT NULL GROUP BY ALL))
  WHERE rank <= 50)"""


@query("contract_allowed_values", ["Q11"], sql=f"WITH {SQL_O}, {SQL_ALLOWED}\nSELECT column_name, value, count, CAST(rank AS INTEGER) AS rank FROM allowed")
def contract_allowed_values(spark, sf_dir):
    train, _ = orders_contract_input(spark, sf_dir)
    _, allowed = contract.build_contract(train.select(*COLS))
    return allowed.select("column_name", "value", "count", F.col("rank").cast("int").alias("rank"))


def _validation_sql():
    q = f"""WITH {SQL_O}, {SQL_ALLOWED},
q AS (SELECT quantile_cont(CAST(o_custkey AS DOUBLE), 0.01) AS c01, quantile_cont(CAST(o_custkey AS DOUBLE), 0.99) AS c99,
             quantile_cont(o_totalprice, 0.01) AS t01, quantile_cont(o_totalprice, 0.99) AS t99,
             1.0e0 - count(o_custkey) / count(*) AS m_o_custkey, 1.0e0 - count(o_totalprice) / count(*) AS m_o_totalprice,
             1.0e0 - count(o_orderstatus) / count(*) AS m_o_orderstatus,
             1.0e0 - count(o_orderpriority) / count(*) AS m_o_orderpriority,
             1.0e0 - count(cust_text) / count(*) AS m_cust_text FROM tr),
j AS (SELECT inc.*, q.*,
        (SELECT count(*) FROM allowed a WHERE a.column_name = 'o_orderstatus' AND a.value = inc.o_orderstatus) AS k1,
        (SELECT count(*) FROM allowed a WHERE a.column_name = 'o_orderpriority' AND a.value = inc.o_orderpriority) AS k2,
        (SELECT count(*) FROM allowed a WHERE a.column_name = 'cust_text' AND a.value = inc.cust_text) AS k3
      FROM inc CROSS JOIN q),
r AS (
  SELECT 'o_custkey' AS column_name, 'numeric' AS kind, any_value(m_o_custkey) AS tm, 1.0e0 - count(o_custkey) / count(*) AS cm,
         avg(CASE WHEN o_custkey < c01 OR o_custkey > c99 THEN 1.0e0 ELSE 0.0e0 END) AS outside, CAST(NULL AS DOUBLE) AS newshare FROM j
  UNION ALL
  SELECT 'o_totalprice', 'numeric', any_value(m_o_totalprice), 1.0e0 - count(o_totalprice) / count(*),
         avg(CASE WHEN o_totalprice < t01 OR o_totalprice > t99 THEN 1.0e0 ELSE 0.0e0 END), NULL FROM j
  UNION ALL
  SELECT 'o_orderstatus', 'categorical', any_value(m_o_orderstatus), 1.0e0 - count(o_orderstatus) / count(*), NULL,
         avg(CASE WHEN o_orderstatus IS NOT NULL AND k1 = 0 THEN 1.0e0 ELSE 0.0e0 END) FROM j
  UNION ALL
  SELECT 'o_orderpriority', 'categorical', any_value(m_o_orderpriority), 1.0e0 - count(o_orderpriority) / count(*), NULL,
         avg(CASE WHEN o_orderpriority IS NOT NULL AND k2 = 0 THEN 1.0e0 ELSE 0.0e0 END) FROM j
  UNION ALL
  SELECT 'cust_text', 'categorical', any_value(m_cust_text), 1.0e0 - count(cust_text) / count(*), NULL,
         avg(CASE WHEN cust_text IS NOT NULL AND k3 = 0 THEN 1.0e0 ELSE 0.0e0 END) FROM j)"""
    return q


@query("contract_validation", ["Q12", "J2", "J10"], sql=_validation_sql() + f"""
SELECT column_name, kind, {sql_rnd('tm', 6)} AS training_missing_rate, {sql_rnd('cm', 6)} AS current_missing_rate,
       {sql_rnd('abs(cm - tm)', 6)} AS missing_rate_change, {sql_rnd('outside', 6)} AS outside_1_99_share,
       {sql_rnd('newshare', 6)} AS new_category_share FROM r
""")
def contract_validation(spark, sf_dir):
    train, incoming = orders_contract_input(spark, sf_dir)
    c = contract.build_contract(train.select(*COLS))
    rep = contract.validate_against_contract(incoming.select(*COLS), c)
    return rep.select("column_name", "kind", *[rnd(x, 6).alias(x) for x in [
        "training_missing_rate", "current_missing_rate", "missing_rate_change", "outside_1_99_share",
        "new_category_share"]])


@query("schema_test", ["Q14", "Q18", "J10"], sql=_validation_sql() + """
SELECT bool_and(cm <= 0.35e0) AS missing_within_limit,
       bool_and(coalesce(newshare <= 0.05e0, true)) AS new_categories_within_limit,
       count(*) AS n_columns_checked, 'o_clerk' AS missing_required_columns, 'o_orderkey' AS extra_columns FROM r
""")
def schema_test(spark, sf_dir):
    train, incoming = orders_contract_input(spark, sf_dir)
    required = COLS + ["o_clerk"]
    c = contract.build_contract(train.select(*COLS))
    inc = incoming.select("o_orderkey", *COLS)
    named = lambda s: F.array_join(F.sort_array(F.collect_list(F.when(F.col("status") == s, F.col("column_name")))), ",")
    sets = contract.column_status(inc, required).agg(named("missing").alias("missing_required_columns"),
                                                     named("extra").alias("extra_columns"))
    rep = contract.validate_against_contract(inc.select(*[x for x in required if x in inc.columns]), c)
    return contract.schema_test(rep).crossJoin(sets).select(
        "missing_within_limit", "new_categories_within_limit", "n_columns_checked",
        "missing_required_columns", "extra_columns")


SQL_ROWS = f"""WITH {SQL_O}, {SQL_ALLOWED},
b AS (SELECT min(o_custkey) AS mn_c, max(o_custkey) AS mx_c, min(o_totalprice) AS mn_t, max(o_totalprice) AS mx_t FROM tr),
j AS (SELECT inc.o_orderkey, list_slice(list_filter([
        CASE WHEN o_custkey IS NULL THEN 'o_custkey:missing' END,
        CASE WHEN o_custkey < mn_c THEN 'o_custkey:below_train_min' END,
        CASE WHEN o_custkey > mx_c THEN 'o_custkey:above_train_max' END,
        CASE WHEN o_totalprice IS NULL THEN 'o_totalprice:missing' END,
        CASE WHEN o_totalprice < mn_t THEN 'o_totalprice:below_train_min' END,
        CASE WHEN o_totalprice > mx_t THEN 'o_totalprice:above_train_max' END,
        CASE WHEN o_orderstatus IS NULL THEN 'o_orderstatus:missing' END,
        CASE WHEN o_orderstatus IS NOT NULL AND a1.value IS NULL THEN 'o_orderstatus:unknown_category' END,
        CASE WHEN o_orderpriority IS NULL THEN 'o_orderpriority:missing' END,
        CASE WHEN o_orderpriority IS NOT NULL AND a2.value IS NULL THEN 'o_orderpriority:unknown_category' END,
        CASE WHEN cust_text IS NULL THEN 'cust_text:missing' END,
        CASE WHEN cust_text IS NOT NULL AND a3.value IS NULL THEN 'cust_text:unknown_category' END],
        lambda x: x IS NOT NULL), 1, 10) AS reasons
      FROM inc CROSS JOIN b
      LEFT JOIN (SELECT value FROM allowed WHERE column_name = 'o_orderstatus') a1 ON a1.value = inc.o_orderstatus
      LEFT JOIN (SELECT value FROM allowed WHERE column_name = 'o_orderpriority') a2 ON a2.value = inc.o_orderpriority
      LEFT JOIN (SELECT value FROM allowed WHERE column_name = 'cust_text') a3 ON a3.value = inc.cust_text)"""


@query("row_validation", ["Q13"], sql=SQL_ROWS + """
SELECT o_orderkey, array_to_string(reasons, ';') AS reasons, CAST(len(reasons) AS INTEGER) AS n_reasons
FROM j WHERE len(reasons) > 0 ORDER BY o_orderkey LIMIT 50
""")
def row_validation(spark, sf_dir):
    train, incoming = orders_contract_input(spark, sf_dir)
    c = contract.build_contract(train.select(*COLS))
    rows = contract.validate_rows(incoming.select("o_orderkey", *COLS), c, NUMS, TEXTS)
    rejected = rows.where(~F.col("accepted")).orderBy("o_orderkey").limit(50)  # first 50 rejects: the feature
    return rejected.select("o_orderkey", F.concat_ws(";", "reasons").alias("reasons"),
                           F.size("reasons").alias("n_reasons"))


@query("row_validation_summary", ["Q13", "Q17"], sql=SQL_ROWS + """
SELECT count(*) FILTER (WHERE len(reasons) = 0) AS n_accepted, count(*) FILTER (WHERE len(reasons) > 0) AS n_rejected,
       CAST(sum(len(reasons)) AS BIGINT) AS n_reasons FROM j
""")
def row_validation_summary(spark, sf_dir):
    train, incoming = orders_contract_input(spark, sf_dir)
    c = contract.build_contract(train.select(*COLS))
    rows = contract.validate_rows(incoming.select("o_orderkey", *COLS), c, NUMS, TEXTS)
    return rows.agg(F.count(F.when(F.col("accepted"), 1)).alias("n_accepted"),
                    F.count(F.when(~F.col("accepted"), 1)).alias("n_rejected"),
                    F.sum(F.size("reasons")).cast("long").alias("n_reasons"))


RANGES = {"l_quantity": (1.0, 45.0), "l_discount": (0.0, 0.08), "l_tax": (0.0, 0.06)}


@query("range_rule_failures", ["Q15", "Q16"], sql=f"""
WITH {SQL_LI_MISSING},
f AS (
  SELECT l_orderkey, 'l_quantity' AS column_name, 'min 1.0' AS rule FROM li WHERE l_quantity < 1.0e0
  UNION ALL SELECT l_orderkey, 'l_quantity', 'max 45.0' FROM li WHERE l_quantity > 45.0e0
  UNION ALL SELECT l_orderkey, 'l_discount', 'min 0.0' FROM li WHERE l_discount < 0.0e0
  UNION ALL SELECT l_orderkey, 'l_discount', 'max 0.08' FROM li WHERE l_discount > 0.08e0
  UNION ALL SELECT l_orderkey, 'l_tax', 'min 0.0' FROM li WHERE l_tax < 0.0e0
  UNION ALL SELECT l_orderkey, 'l_tax', 'max 0.06' FROM li WHERE l_tax > 0.06e0
  UNION ALL SELECT l_orderkey, 'l_returnflag', 'domain' FROM li WHERE l_returnflag IS NOT NULL AND l_returnflag NOT IN ('A', 'R')
  UNION ALL SELECT l_orderkey, 'l_extendedprice', 'not null' FROM li WHERE l_extendedprice IS NULL)
SELECT column_name, rule, count(*) AS n_failures, CAST(sum(l_orderkey) AS BIGINT) AS key_sum FROM f GROUP BY ALL
""")
def range_rule_failures(spark, sf_dir):
    li = lineitem_missing(spark, sf_dir)
    f = contract.range_rule_failures(li, LI_KEY, RANGES, {"l_returnflag": ["A", "R"]}, ["l_extendedprice"])
    return f.groupBy("column_name", "rule").agg(F.count(F.lit(1)).alias("n_failures"),
                                                F.sum("l_orderkey").alias("key_sum"))


@query("strict_quarantine", ["Q17", "T7"], sql=f"""
WITH {SQL_LI_MISSING},
f AS (SELECT (l_quantity IS NULL OR l_extendedprice IS NULL OR l_discount IS NULL OR l_tax IS NULL
              OR l_returnflag IS NULL OR l_quantity < 1.0e0 OR l_quantity > 45.0e0
              OR l_discount < 0.0e0 OR l_discount > 0.08e0 OR l_tax < 0.0e0 OR l_tax > 0.06e0) AS bad FROM li)
SELECT count(*) FILTER (WHERE NOT bad) AS n_accepted, count(*) FILTER (WHERE bad) AS n_quarantined FROM f
""")
def strict_quarantine(spark, sf_dir):
    li = lineitem_missing(spark, sf_dir)
    bad = F.lit(False)
    for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]:
        bad = bad | F.col(c).isNull()
    for c, (lo, hi) in RANGES.items():
        bad = bad | (F.col(c) < lo) | (F.col(c) > hi)
    ok, rejected = contract.quarantine_split(li, F.coalesce(bad, F.lit(True)))
    return ok.agg(F.count(F.lit(1)).alias("n_accepted")).crossJoin(
        rejected.agg(F.count(F.lit(1)).alias("n_quarantined")))
