"""Source extracts derived from the driver's TPC-H-style tables.

The reference reads two exports of construction projects (a *program* extract and an
*outcome* extract) plus a contract sheet.  These functions derive extracts of the same
shape from ``orders``, ``customer``, ``nation``, ``lineitem`` and ``part`` so every
operator runs over whole tables and its work grows with the scale factor:

* program  = orders placed from 1998 on (the active six-year program),
* outcome  = orders placed before 2000 (rated history; without line items they count as on time),
* contracts = one row per (contract, project), a contract being a part and a
  order-key class, so several projects share one contract.

Text columns are padded and dates are rendered as source text so staging has real
work to do; NULLs, zero budgets, a rare category and negative placeholder keys are
planted by rule.  Each function has a SQL twin in ``projectpulse.plans.oracle`` that
DuckDB runs as the independent oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from projectpulse.operators.joins import BROADCAST_MAX_ROWS
from projectpulse.sources.layout import tasks_for
from projectpulse.sources.readers import read_table

# Fixed values of the extract recipe.
PROGRAM_FROM = "1998-01-01 00:00:00"
OUTCOME_BEFORE = "2000-01-01 00:00:00"
SOURCE_TS_TEXT = "M/d/yyyy h:mm:ss a"
CONTRACT_EPOCH = "1998-01-01"
RARE_UP_TO = 64  # orders with the rare category: the first keys, as many at every scale


def _ts_lit(df: DataFrame, col: str, text: str) -> Column:
    """A literal of the column's own timestamp type, so the filter reaches the scan."""
    return F.lit(text).cast(df.schema[col].dataType)


def _money_text(x: Column) -> Column:
    """Whole dollars as text (identical in every engine)."""
    return F.floor(x).cast("bigint").cast("string")


def _ts_text(ts: Column, days: int, hours: Column) -> Column:
    return F.date_format(ts + F.make_dt_interval(F.lit(days), hours.cast("int")), SOURCE_TS_TEXT)


def _orders_with_customer(spark: SparkSession, sf_dir: str, where) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    orders = orders.where(where(orders))
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .join(nation, F.col("c_nationkey") == nation.n_nationkey))


def raw_program(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Program extract as landed text (the CSV export's columns)."""
    base = _orders_with_customer(spark, sf_dir,
                                 lambda o: o.o_orderdate >= _ts_lit(o, "o_orderdate", PROGRAM_FROM))
    k = F.col("o_orderkey")
    price = F.col("o_totalprice")
    ts = F.col("o_orderdate")
    return base.select(
        F.when(k % 97 == 1, -k).otherwise(k).alias("UPC"),
        F.concat(F.lit("  "), F.col("n_name"), F.lit(" ")).alias("DISTRICT_CODE_DESC"),
        F.concat(F.col("o_orderpriority"), F.lit(" ")).alias("STATE_HIGHWAY_DESC"),
        F.when(k % 1009 == 0, F.lit(None).cast("string"))
         .when(k <= RARE_UP_TO, F.lit("RARE"))
         .otherwise(F.concat(F.lit(" "), F.col("c_mktsegment"))).alias("SCOPE_OF_WORK_DESC"),
        F.col("o_orderstatus").alias("POOL_PRJ_STATUS_DSC"),
        F.when(k % 2 == 0, "true").otherwise("false").alias("HAS_PE"),
        F.when(k % 3 == 0, "true").otherwise("false").alias("HAS_RW"),
        F.when(F.col("o_orderstatus") == "O", "false").otherwise("true").alias("HAS_CN"),
        _ts_text(ts, 0, k % 24).alias("PE_START_DATE"),
        F.when(k % 3 == 0, _ts_text(ts, 30, (k + 5) % 24)).alias("RW_START_DATE"),
        _ts_text(ts, 90, (k + 11) % 24).alias("CN_START_DATE"),
        F.when(F.col("o_orderstatus") == "F", _ts_text(ts, 400, (k + 17) % 24)).alias("CN_END_DATE"),
        F.when(k % 23 == 0, F.lit(None).cast("string"))
         .when(k % 29 == 0, F.lit("0"))
         .otherwise(_money_text(price)).alias("TOTAL_ALLOCATIONS_CURRENT"),
        _money_text(price * 6 / 10).alias("Y1_Y6_ALLOCATIONS"),
        _money_text(price / 10).alias("CURRENT_PE_ESTIMATE"),
        F.when(k % 3 == 0, _money_text(price / 20)).alias("CURRENT_RW_ESTIMATE"),
        _money_text(price * 8 / 10).alias("CURRENT_CN_ESTIMATE"),
        F.when(k % 31 == 0, F.lit(None).cast("string"))
         .otherwise(_money_text(price * (k % 7 + 7) / 10)).alias("TOTAL_EST_CURRENT"),
        F.year(ts).cast("string").alias("CURRENT_YEAR"),
    )


def raw_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome extract (the dashboard's project sheet) as landed text."""
    base = _orders_with_customer(spark, sf_dir,
                                 lambda o: o.o_orderdate < _ts_lit(o, "o_orderdate", OUTCOME_BEFORE))
    # First return flag per order.  The flag is a one-letter code, so the minimum is
    # taken over its code point: a fixed-width value keeps the aggregate hash-based
    # (partial map-side, no sort), where min() of a string would sort every line item.
    flags = (read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
             .agg(F.chr(F.min(F.ascii("l_returnflag"))).alias("ft")))
    base = base.join(flags, base.o_orderkey == flags.l_orderkey, "left")
    k = F.col("o_orderkey")
    price = F.col("o_totalprice")
    ft = F.col("ft")
    budget_null = k % 11 == 0
    return base.select(
        k.alias("UPC"),
        F.concat(F.lit("  "), F.col("n_name")).alias("DISTRICT"),
        F.concat(F.lit(" "), F.col("o_orderpriority")).alias("ROAD_SYSTEM"),
        F.when(k <= RARE_UP_TO, F.lit("RARE")).otherwise(F.col("c_mktsegment")).alias("SCOPE_OF_WORK"),
        F.col("o_orderstatus").alias("PROJECT_STATUS"),
        _money_text(price * 9 / 10).alias("BUDGET"),
        _money_text(price).alias("ESTIMATE"),
        F.concat(F.lit("FY"), F.year(F.col("o_orderdate")).cast("string")).alias("FISCAL_YEAR"),
        F.when(ft == "R", "R").when(ft == "N", "Y").otherwise("G").alias("ON_TIME_STATUS"),
        F.when(ft == "R", " Late acceptance ").when(ft == "N", "Pending work")
         .otherwise("On schedule").alias("ON_TIME_STATUS_REASON"),
        F.when(budget_null, F.lit(None).cast("string"))
         .when((price > 300000) & (F.col("o_orderstatus") == "F"), "R")
         .when(price > 250000, "Y").otherwise("G").alias("ON_BUDGET_STATUS"),
        F.when(budget_null, F.lit(None).cast("string"))
         .when(price > 250000, "Estimate above budget ")
         .otherwise("Within budget").alias("ON_BUDGET_STATUS_REASON"),
    )


def contract_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Over how many tasks the contract sheet is spread (rows come from the files' footers)."""
    return tasks_for(read_table(spark, sf_dir, "lineitem").count())


def raw_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract sheet at grain (contract, project), typed as a workbook reader gives it.

    Pairs of keys are few bytes and become wide rows, which the aggregates that follow sort: they are dealt over a
    number of tasks that grows with the rows, after the join as well where that may be a shuffle of its own."""
    li = read_table(spark, sf_dir, "lineitem")
    tasks = contract_tasks(spark, sf_dir)
    pairs = (li.select((F.col("l_partkey") * 10 + F.col("l_orderkey") % 10).alias("k"),
                       F.col("l_orderkey").alias("upc"), F.col("l_partkey"))
             .repartition(tasks, "k", "upc", "l_partkey").distinct())
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_brand")
    x = pairs.join(part, pairs.l_partkey == part.p_partkey)
    if part.count() > BROADCAST_MAX_ROWS:
        x = x.repartition(tasks, "k", "upc")
    k = F.col("k")
    price = F.col("p_retailprice")
    epoch = F.lit(CONTRACT_EPOCH).cast("date")

    def day(offset: Column) -> Column:
        return F.date_add(epoch, offset.cast("int")).cast("timestamp")

    slip = (k * 37) % 61 - 30
    return x.select(
        k.alias("CONTRACT_ID"),
        F.col("upc").alias("UPC"),
        F.concat(F.lit("D"), (k % 9).cast("string"), F.lit(" ")).alias("DISTRICT"),
        F.col("p_brand").alias("ROAD_SYSTEM"),
        day(k % 700).alias("ORIGINAL_SPECIFIED_COMPLETION_DATE"),
        day(k % 700 + k % 15).alias("CURRENT_SPECIFIED_COMPLETION_DATE"),
        F.when(k % 8 == 0, F.lit(None).cast("timestamp"))
         .otherwise(day(k % 700 + slip) + F.make_dt_interval(F.lit(0), (k % 24).cast("int")))
         .alias("ACCEPTANCE_DATE"),
        F.when(k % 101 == 0, F.lit(0.0)).otherwise(price * 100).alias("CONTRACT_AWARD_AMOUNT"),
        (price * (k % 20 + 95)).alias("CURRENT_CONTRACT_AMOUNT"),
        F.when(k % 3 == 0, F.lit(None).cast("double")).otherwise(price * (k % 30 + 90))
         .alias("UN_AUDITED_FINAL_COST"),
        F.when(slip > 0, "R").when(slip > -10, "Y").otherwise("G").alias("ON_TIME_STATUS"),
        F.when(k % 30 >= 10, "R").otherwise("G").alias("ON_BUDGET_STATUS"),
    )


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and score per order for the evaluation operators (ties on purpose)."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        (F.floor(F.col("o_totalprice") / 5000) / 100.0).alias("score"),
    )
