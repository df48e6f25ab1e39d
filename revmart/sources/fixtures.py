"""The driver's star-schema tables mapped onto the warehouse inputs.

Payments: one ``lineitem`` row is one version of the payment whose id is
its order key. Rate dimensions: full snapshots derived from ``part`` brands
and ``nation`` keys at three run times, with changed, unchanged, missing
and unmatched keys. Every table is derived by Spark from the given tables,
so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revmart.functions.columns import hours_after, rate_from_units, ts_lit
from revmart.sources.tables import read_table

# Fixed values of the mapping.
STATUS_BY_RETURNFLAG = {"N": "confirmed", "A": "pending", "R": "rejected"}
TYPE_BY_LINESTATUS = {"O": "recarga", "F": "other"}
SNAPSHOT_RUNS = ["1996-01-01 00:00:00", "1998-01-01 00:00:00", "2000-01-01 00:00:00"]
PROVIDER_COUNT = 10
OMITTED_NATION = 24

TIEBREAK = ["l_suppkey", "l_partkey"]


def _case(col: str, mapping: dict[str, str]):
    expr = None
    for key, value in mapping.items():
        expr = (F.when(F.col(col) == key, value) if expr is None
                else expr.when(F.col(col) == key, value))
    return expr


def source_payments(spark: SparkSession, sf_dir: str, with_tiebreak: bool = True,
                    linestatus: str | None = None) -> DataFrame:
    """The OLTP payments table (all types), plus the tie-break columns.

    ``linestatus`` filters lineitem at the scan (pushed into parquet), which
    is how a filter on the mapped ``type`` reaches the file.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate")
    if linestatus is not None:
        li = li.where(F.col("l_linestatus") == linestatus)
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # customers go to the orders, not to each of their lines
    j = (li.join(part, F.col("l_partkey") == F.col("p_partkey"))
         .join(orders.join(customer, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey")))
    cols = [
        F.col("l_orderkey").cast("string").alias("transaction_id"),
        F.col("o_orderdate").alias("created_at"),
        F.col("l_shipdate").alias("updated_at"),
        _case("l_returnflag", STATUS_BY_RETURNFLAG).alias("status"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
        _case("l_linestatus", TYPE_BY_LINESTATUS).alias("type"),
        F.col("p_brand").alias("company_code"),
        F.concat(F.lit("PROV_"), (F.col("l_suppkey") % 10).cast("string")).alias("external_provider_id"),
        F.concat(F.lit("CLIENT_"), F.col("c_nationkey").cast("string")).alias("client_id"),
        F.concat(F.lit("USER_"), F.col("o_custkey").cast("string")).alias("external_client_id"),
        hours_after("l_shipdate", "l_linenumber").alias("fixture_loaded_at"),
    ]
    if with_tiebreak:
        cols += [F.col(c) for c in TIEBREAK]
    return j.select(*cols)


def raw_payments(spark: SparkSession, sf_dir: str, with_tiebreak: bool = True) -> DataFrame:
    """The append-only raw log as the extract would have filled it (recarga only)."""
    recarga = next(k for k, v in TYPE_BY_LINESTATUS.items() if v == "recarga")
    src = source_payments(spark, sf_dir, with_tiebreak, linestatus=recarga)
    return src.withColumnRenamed("fixture_loaded_at", "loaded_at")


def brand_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct brands with their rank by name from 0 (a handful of rows)."""
    brands = read_table(spark, sf_dir, "part").select("p_brand").distinct()
    # The window sees only the distinct brands, a set bounded by the catalogue.
    return brands.select("p_brand", (F.row_number().over(
        Window.orderBy("p_brand")) - 1).alias("b"))


def _snapshot_runs():
    return F.explode(F.array(*[F.struct(F.lit(e).alias("e"), ts_lit(ts).alias("run_ts"))
                               for e, ts in enumerate(SNAPSHOT_RUNS)]))


def provider_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All provider-rate snapshots: provider_id, biller_id, commission_rate, commission_type, run_ts."""
    pairs = brand_ranks(spark, sf_dir).select(
        "p_brand", "b", F.explode(F.sequence(F.lit(0), F.lit(PROVIDER_COUNT - 1))).alias("p"))
    pb = F.col("p") + F.col("b")
    runs = pairs.where(pb % 11 != 0).select("*", _snapshot_runs().alias("s")).select(
        "p_brand", "b", "p", "s.e", "s.run_ts")
    runs = runs.where(~((F.col("e") == 2) & (pb % 7 == 0)))
    e_eff = F.when(pb % 3 == 0, F.lit(0)).otherwise(F.col("e"))
    units = F.lit(400) + (F.lit(7) * F.col("p") + F.lit(3) * F.col("b") + F.lit(5) * e_eff) % 200
    return runs.select(
        F.concat(F.lit("PROV_"), F.col("p").cast("string")).alias("provider_id"),
        F.col("p_brand").alias("biller_id"),
        rate_from_units(units).alias("commission_rate"),
        F.lit("amount").alias("commission_type"),
        "run_ts")


def client_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All client-share snapshots: client_id, revenue_share, commission_type, run_ts."""
    nations = read_table(spark, sf_dir, "nation").select("n_nationkey").where(
        F.col("n_nationkey") != OMITTED_NATION)
    runs = nations.select("n_nationkey", _snapshot_runs().alias("s")).select(
        "n_nationkey", "s.e", "s.run_ts")
    n = F.col("n_nationkey")
    e_eff = F.when(n % 3 == 0, F.lit(0)).otherwise(F.col("e"))
    units = F.lit(5000) + (F.lit(137) * n + F.lit(250) * e_eff) % 2000
    return runs.select(
        F.concat(F.lit("CLIENT_"), n.cast("string")).alias("client_id"),
        rate_from_units(units).alias("revenue_share"),
        F.lit("revenue_share").alias("commission_type"),
        "run_ts")


def provider_source(spark: SparkSession, sf_dir: str, run: int) -> DataFrame:
    """The OLTP provider-commission table as it was at snapshot ``run``."""
    snaps = provider_snapshots(spark, sf_dir).where(F.col("run_ts") == ts_lit(SNAPSHOT_RUNS[run]))
    return snaps.select(F.col("provider_id").alias("external_provider_id"),
                        F.col("biller_id").alias("company_code"),
                        "commission_rate", "commission_type")


def client_source(spark: SparkSession, sf_dir: str, run: int) -> DataFrame:
    snaps = client_snapshots(spark, sf_dir).where(F.col("run_ts") == ts_lit(SNAPSHOT_RUNS[run]))
    return snaps.select("client_id", "revenue_share", "commission_type")


# ---- rates of every supplier x part and of every customer: they grow with the tables ----------

def large_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log with the rate keys supplier, part and customer."""
    return raw_payments(spark, sf_dir).withColumns({
        "external_provider_id": F.concat(F.lit("SUPP_"), F.col("l_suppkey").cast("string")),
        "company_code": F.concat(F.lit("PART_"), F.col("l_partkey").cast("string")),
        "client_id": F.replace(F.col("external_client_id"), F.lit("USER_"), F.lit("CUST_"))})


def supplier_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier and part that occur together."""
    return read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").distinct()


def large_provider_snapshots(pairs: DataFrame) -> DataFrame:
    """A rate for each of ``supplier_parts``, by the rule of ``provider_snapshots``."""
    key = F.col("l_suppkey") + F.col("l_partkey")
    runs = pairs.where(key % 11 != 0).select("*", _snapshot_runs().alias("s")).select("*", "s.*")
    runs = runs.where(~((F.col("e") == 2) & (key % 7 == 0)))
    e_eff = F.when(key % 3 == 0, F.lit(0)).otherwise(F.col("e"))
    units = F.lit(400) + (F.lit(7) * F.col("l_suppkey") + F.lit(3) * F.col("l_partkey") + F.lit(5) * e_eff) % 200
    return runs.select(
        F.concat(F.lit("SUPP_"), F.col("l_suppkey").cast("string")).alias("provider_id"),
        F.concat(F.lit("PART_"), F.col("l_partkey").cast("string")).alias("biller_id"),
        rate_from_units(units).alias("commission_rate"), F.lit("amount").alias("commission_type"), "run_ts")


def large_client_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A share for each customer (but every 25th), by the rule of ``client_snapshots``."""
    n = F.col("c_custkey")
    runs = (read_table(spark, sf_dir, "customer").select("c_custkey").where(n % 25 != OMITTED_NATION)
            .select("c_custkey", _snapshot_runs().alias("s")).select("c_custkey", "s.*"))
    e_eff = F.when(n % 3 == 0, F.lit(0)).otherwise(F.col("e"))
    units = F.lit(5000) + (F.lit(137) * n + F.lit(250) * e_eff) % 2000
    return runs.select(
        F.concat(F.lit("CUST_"), n.cast("string")).alias("client_id"),
        rate_from_units(units).alias("revenue_share"), F.lit("revenue_share").alias("commission_type"), "run_ts")
