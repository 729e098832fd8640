"""Operator bindings to the driver's tables (FIXTURES §2).

Each binding is ``fn(spark, sf_dir) -> DataFrame`` and its oracle SQL (in
``plans.oracle``) is written independently against the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import analytics as A
from ..operators import dedup as D
from ..operators import quality as Q
from ..operators import scd2 as S
from ..operators import transform as TR
from ..session import table_path
from .ranking import global_positions

AS_OF = "2001-08-02"  # fixed value: as-of date of the bindings (day after the last order)

BINDINGS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def binding(name: str):
    def deco(fn):
        BINDINGS[name] = fn
        return fn
    return deco


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(d, name))


# ------------------------------------------------------------- analytics
@binding("top_customers_per_month")
def _a20(spark, d):
    return A.top_customers_per_month(t(spark, d, "orders"), customer="o_custkey", ts="o_orderdate",
                                     amount="o_totalprice", n=5)


@binding("burst_events")
def _a01(spark, d):
    ev = t(spark, d, "events").select("user_id", "event_id", "ts")
    return A.burst_events(ev, "user_id", "ts", window="1 day", min_count=8)


@binding("customer_tiers")
def _a02(spark, d):
    return A.customer_tiers(t(spark, d, "orders"), "o_custkey", "o_totalprice")


@binding("first_purchase")
def _a03(spark, d):
    return A.first_purchase(t(spark, d, "orders"), "o_custkey", "o_orderdate", tie_break=["o_orderkey"])


@binding("outliers_sigma")
def _a04(spark, d):
    ev = t(spark, d, "events").select("user_id", "event_id", "ts", "value")
    return A.outliers_sigma(ev, "user_id", "value", k=3.0)


@binding("purchase_funnel")
def _a05(spark, d):
    ev = t(spark, d, "events")
    stage = lambda kind: ev.filter(F.col("event_type") == kind)
    return A.purchase_funnel([("visits", stage("view"), "user_id"),
                              ("cart", stage("click"), "user_id"),
                              ("purchases", stage("purchase"), "user_id")])


@binding("inactive_customers")
def _a06(spark, d):
    return A.inactive_customers(t(spark, d, "customer"), t(spark, d, "orders"), AS_OF,
                                customer="c_custkey", order_customer="o_custkey",
                                order_ts="o_orderdate", days=90)


@binding("market_basket_pairs")
def _a08(spark, d):
    return A.market_basket_pairs(t(spark, d, "lineitem"), "l_orderkey", "l_partkey", max_rank=10)


@binding("monthly_revenue_growth")
def _a09(spark, d):
    return A.monthly_revenue_growth(t(spark, d, "orders"), "o_orderdate", "o_totalprice")


@binding("churn_risk")
def _a10(spark, d):
    out = A.churn_risk(t(spark, d, "orders"), "o_custkey", "o_orderdate", AS_OF, factor=2.0)
    return out.withColumn("avg_gap", F.round("avg_gap", 6))


@binding("activity_streaks")
def _a11(spark, d):
    return A.activity_streaks(t(spark, d, "events"), "user_id", "ts", min_len=5)


LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey"]


@binding("find_duplicates")
def _a12(spark, d):
    li = t(spark, d, "lineitem")
    first = li.filter(F.col("l_linenumber") == 1)          # exact copies: one more, or two more
    copies = li.unionByName(first).unionByName(first.filter(F.col("l_orderkey") % 3 == 0))
    return D.find_duplicates(copies, LINE_KEYS, LINE_ORDER)


@binding("dedup_keep_first")
def _a13(spark, d):
    return D.dedup_keep_first(t(spark, d, "lineitem"), LINE_KEYS, LINE_ORDER)


@binding("merge_insert_new")
def _a15(spark, d):
    li = t(spark, d, "lineitem")
    target = li.filter(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return D.merge_insert_new(target, li, LINE_KEYS, LINE_ORDER)


@binding("scd2_intervals")
def _a16(spark, d):
    return S.scd2_intervals(t(spark, d, "orders"), "o_custkey", "o_orderpriority", "o_orderdate",
                            tie_break=["o_orderkey"])


@binding("time_between_purchases")
def _a17(spark, d):
    o = t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return A.time_between_purchases(o, "o_custkey", "o_orderdate", tie_break=["o_orderkey"])


@binding("top_n_dense_rank")
def _a18(spark, d):
    li = t(spark, d, "lineitem")
    amount = (F.col("l_extendedprice").cast("decimal(18,2)")
              * (F.lit(1) - F.col("l_discount").cast("decimal(18,2)")))
    per_supplier = li.groupBy("l_suppkey").agg(F.sum(amount).alias("_rev"))
    nation = t(spark, d, "nation")   # fixed-size dimension (25 rows by spec): broadcast is bounded
    region = t(spark, d, "region")   # fixed-size dimension (5 rows)
    sales = (per_supplier.join(t(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
             .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
             .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
             .select(F.col("r_name").alias("region"), F.col("s_name").alias("salesperson"),
                     F.round("_rev", 2).cast("double").alias("revenue")))
    return A.top_n_dense_rank(sales, "region", "revenue", n=3)


@binding("top_products_by_category")
def _a19(spark, d):
    return A.top_products_by_category(t(spark, d, "lineitem"), t(spark, d, "part"), product="p_partkey",
                                      category="p_type", quantity="l_quantity",
                                      item_product="l_partkey", n=3)


@binding("sessionize")
def _a21(spark, d):
    ev = t(spark, d, "events").select("user_id", "event_id", "ts")
    return A.sessionize(ev, "user_id", "ts", gap="30 minutes", tie_break=["event_id"])


# ------------------------------------------------------------- quality
def _docs_labels(spark, d):
    return t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id", "left")


@binding("null_ratio_check")
def _q01(spark, d):
    return Q.null_ratio_check(_docs_labels(spark, d), {"quality": 0.5, "lang": 0.0})


@binding("number_range_check")
def _q02(spark, d):
    return Q.number_range_check(t(spark, d, "orders"), "o_totalprice", 0, 400000)


@binding("date_range_check")
def _q03(spark, d):
    return Q.date_range_check(t(spark, d, "orders"), "o_orderdate", "1996-01-01", "2000-12-31")


@binding("partition_skew")
def _q04(spark, d):
    return Q.partition_skew(t(spark, d, "documents"), "lang", threshold=2.0)


def _intervals_with_overlaps(spark, d):
    iv = S.scd2_intervals(t(spark, d, "orders"), "o_custkey", "o_orderpriority", "o_orderdate",
                          tie_break=["o_orderkey"])
    # urgent orders' intervals are stretched one day past the next change
    stretched = F.when((F.col("o_orderpriority") == "1-URGENT")
                       & (F.col("valid_to") < F.lit("9999-12-31").cast("timestamp_ntz")),
                       F.col("valid_to") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("valid_to"))
    return iv.withColumn("valid_to", stretched)


@binding("scd2_overlaps")
def _q05(spark, d):
    iv = _intervals_with_overlaps(spark, d).drop("o_orderpriority")
    return S.scd2_overlaps(iv, "o_custkey", "valid_from", "valid_to", mode="adjacent",
                           tie_break=["o_orderkey"])


@binding("scd2_overlaps_any")
def _q05b(spark, d):
    iv = _intervals_with_overlaps(spark, d).drop("o_orderpriority")
    return S.scd2_overlaps(iv, "o_custkey", "valid_from", "valid_to", mode="any",
                           tie_break=["o_orderkey"])


@binding("scd2_single_current")
def _q06(spark, d):
    iv = S.scd2_intervals(t(spark, d, "orders"), "o_custkey", "o_orderpriority", "o_orderdate",
                          tie_break=["o_orderkey"])
    flagged = iv.withColumn("is_current", (F.col("valid_to") == F.lit("9999-12-31").cast("timestamp_ntz"))
                            | (F.col("o_orderpriority") == "1-URGENT"))
    return S.scd2_single_current(flagged, "o_custkey", "is_current")


@binding("table_freshness")
def _q07(spark, d):
    return Q.table_freshness(t(spark, d, "orders"), AS_OF, ts="o_orderdate")


@binding("small_file_report")
def _q08(spark, d):
    path = scratch_path(spark, "lineitem_files")
    # one file a (flag, month), each written by a task of its own
    li = t(spark, d, "lineitem").withColumn("ship_month", F.date_format("l_shipdate", "yyyyMM"))
    li.repartition("l_returnflag", "ship_month").write.partitionBy("l_returnflag", "ship_month").parquet(path)
    return (Q.small_file_report(spark, path, by="l_returnflag")
            .select("l_returnflag", "num_files", (F.col("total_bytes") > 0).alias("has_bytes"), "small_files",
                    "too_many_files", "needs_compaction"))


@binding("duplicate_check")
def _q09(spark, d):
    return Q.duplicate_check(t(spark, d, "documents"), "text")


@binding("referential_integrity")
def _q10(spark, d):
    return Q.referential_integrity(t(spark, d, "documents"), t(spark, d, "labels"), "doc_id")


@binding("row_count_compare")
def _q11(spark, d):
    li = t(spark, d, "lineitem")
    return Q.row_count_compare(li, D.dedup_keep_first(li, LINE_KEYS, LINE_ORDER))


@binding("schema_check")
def _q12(spark, d):
    from pyspark.sql import types as T
    expected = T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.IntegerType()),
        T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DecimalType(8, 2)),
        T.StructField("o_orderdate", T.DateType()), T.StructField("o_comment", T.StringType()),
    ])
    return Q.schema_check(t(spark, d, "orders"), expected)


# ------------------------------------------------------------- transforms
@binding("add_row_id_and_hash")
def _t01(spark, d):
    c = t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return TR.add_row_id_and_hash(c, ["c_custkey", "c_name", "c_mktsegment"], key_cols=["c_custkey"],
                                  mode="compat")


SCD_START = "2020-01-01 00:00:00"  # fixed value: start of the initial dimension versions
SCD_NOW = "2024-01-01 00:00:00"    # fixed value: the merge run's "now"


@binding("scd2_merge")
def _t02(spark, d):
    cust = t(spark, d, "customer")
    current = cust.filter(F.col("c_nationkey") < 20).select(
        F.col("c_custkey").alias("SurrogateKey"), "c_custkey", "c_mktsegment", "c_nationkey",
        F.lit(SCD_START).cast("timestamp_ntz").alias("Start_Date"),
        F.lit(None).cast("timestamp_ntz").alias("End_Date"), F.lit(True).alias("Flg_Is_Current"))
    new = cust.select("c_custkey",
                      F.when(F.col("c_acctbal") < 0, F.concat("c_mktsegment", F.lit("_NEW")))
                       .otherwise(F.col("c_mktsegment")).alias("c_mktsegment"), "c_nationkey")
    return S.scd2_merge(new, current, "c_custkey", ["c_mktsegment", "c_nationkey"],
                        now=F.lit(SCD_NOW).cast("timestamp_ntz"))


@binding("standardize_table")
def _t03(spark, d):
    li = t(spark, d, "lineitem")
    messy = li.toDF(*[" " + c.replace("_", " ").upper() + " " for c in li.columns])
    return TR.standardize_table(messy)


@binding("normalize_by_max")
def _t04(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return TR.normalize_by_max(o, "o_totalprice", "price_ratio")


@binding("drop_sensitive_columns")
def _t05(spark, d):
    return TR.drop_sensitive_columns(t(spark, d, "customer"), ["c_acctbal"])


@binding("global_order")
def _t13(spark, d):
    return TR.global_order(t(spark, d, "orders"), [F.col("o_totalprice").desc(), F.col("o_orderkey")])


# ------------------------------------------------------------- json, text
from ..operators import graph as G  # noqa: E402
from ..operators import jsonops as J  # noqa: E402
from ..operators import text as TX  # noqa: E402
from ..session import scratch_path  # noqa: E402
from ..sources import files as FS  # noqa: E402
from ..sources import ingest as IN  # noqa: E402
from ..sources import logs as LG  # noqa: E402
from ..sources import tables as TB  # noqa: E402
from ..streaming import merge as SM  # noqa: E402
from ..streaming import sessions as SS  # noqa: E402

ITEMS_PER_PAYLOAD = 4  # lines per JSON document of the A07 fixture


def order_payloads(spark, d, with_key: bool = False) -> DataFrame:
    """JSON documents {order_id, customer:{id}, items:[{product_id, price}]}
    derived from orders + lineitem, at most ITEMS_PER_PAYLOAD items each."""
    li = t(spark, d, "lineitem")
    items = (li.groupBy("l_orderkey", F.ceil(F.col("l_linenumber") / ITEMS_PER_PAYLOAD).alias("_chunk"))
               .agg(F.collect_list(F.struct(F.col("l_partkey").alias("product_id"),
                                            F.col("l_extendedprice").alias("price"))).alias("items")))
    o = t(spark, d, "orders")
    doc = F.to_json(F.struct(F.col("o_orderkey").alias("order_id"),
                             F.struct(F.col("o_custkey").alias("id")).alias("customer"), "items"))
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("_chunk").cast("string"))
    cols = [key.alias("doc_key")] if with_key else []
    return items.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(*cols, doc.alias("payload"))


@binding("json_flatten")
def _a07(spark, d):
    return J.json_flatten(order_payloads(spark, d), "payload",
                          {"order_id": ("order_id", "bigint"), "customer_id": ("customer.id", "bigint")},
                          "items", {"product_id": ("product_id", "bigint"), "price": ("price", "double")})


@binding("clean_place_names")
def _t06(spark, d):
    return TX.clean_place_names(t(spark, d, "documents").select("doc_id", "text"), "text", "text_clean") \
             .select("doc_id", "text_clean")


def _dirty_names(spark, d):
    return t(spark, d, "part").select(F.regexp_replace("p_name", "[aeiou]", "").alias("name"))


@binding("fuzzy_match")
def _t07(spark, d):
    return TX.fuzzy_match(_dirty_names(spark, d), t(spark, d, "part"), "name", "p_name", cutoff=60)


@binding("strip_control_chars")
def _t08(spark, d):
    return TX.strip_control_chars(t(spark, d, "documents").select("doc_id", "text"), "text")


@binding("match_quality")
def _t09(spark, d):
    return TX.match_quality(_dirty_names(spark, d), t(spark, d, "part"), "name", "p_name", cutoff=60)


def _document_lexicon(docs: DataFrame) -> DataFrame:
    """A polarity for every word of the documents (tens of thousands), from
    the word's own hash: multiples of 1/8 between -1 and 1."""
    words = docs.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")).filter("word <> ''").distinct()
    number = F.conv(F.substring(F.md5("word"), 1, 4), 16, 10).cast("int")
    return words.withColumn("polarity", (number % 17 - 8) / F.lit(8.0))


@binding("sentiment_label")
def _t10(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "text")
    return TX.sentiment_label(docs, "text", _document_lexicon(docs)).select("doc_id", "polarity", "sentiment")


@binding("json_to_tables")
def _t11(spark, d):
    ev = t(spark, d, "events").select("event_id", "props")
    return J.json_to_tables(ev, "props", key_col="event_id")[()]


@binding("json_to_tables_children")
def _t11b(spark, d):
    tabs = J.json_to_tables(order_payloads(spark, d, with_key=True), "payload", key_col="doc_key")
    return tabs[("items",)].select("root_id", "product_id", "price")


def nested_payloads(spark, d) -> DataFrame:
    """A JSON document per order and 4 lines with what trips schema readers:
    equal child names, a dotted and a quoted key, a field named root, arrays
    in arrays in objects, names that differ in case only, a type conflict."""
    li = t(spark, d, "lineitem")
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    chunks = (li.groupBy(F.col("l_orderkey").alias("o"), F.ceil(F.col("l_linenumber") / ITEMS_PER_PAYLOAD).alias("c"))
                .agg(F.array_sort(F.collect_list(line)).alias("lines")))
    pair = lambda x: F.array(x["l_suppkey"], x["l_linenumber"].cast("long"))
    even = F.col("o") % 2 == 0
    return chunks.select(
        F.concat_ws("-", F.col("o").cast("string"), F.col("c").cast("string")).alias("doc_key"),
        F.concat(
            F.lit('{"id":'), F.col("o").cast("string"), F.lit(',"p.q":"x'), F.col("c").cast("string"),
            F.lit('","it\'s":'), F.col("c").cast("string"), F.lit(',"Id":'), (F.col("o") * 2).cast("string"),
            F.lit(',"root":{"even":'), even.cast("string"), F.lit('},"mixed":'),
            F.when(even, F.col("o").cast("string")).otherwise(F.concat(F.lit('{"n":'), F.col("o").cast("string"), F.lit("}"))),
            F.lit(',"a":{"items":'), F.to_json(F.transform("lines", lambda x: x["l_partkey"])),
            F.lit('},"b":{"items":'),
            F.to_json(F.transform("lines", lambda x: F.struct(x["l_extendedprice"].alias("price"), F.array(pair(x), pair(x)).alias("tags")))),
            F.lit("}}")).alias("payload"))


def _nested_table(path: tuple, columns: list[str]):
    def run(spark, d):
        return J.json_to_tables(nested_payloads(spark, d), "payload", key_col="doc_key")[path].toDF(*columns)

    return run


for _name, _path, _columns in (
        ("json_nested_root", (), ["doc_key", "twice", "id", "quoted", "mixed", "dotted"]),
        ("json_nested_field_root", ("root",), ["root_id", "even"]),
        ("json_nested_a_items", ("a", "items"), ["root_id", "pos_1", "value"]),
        ("json_nested_b_items", ("b", "items"), ["root_id", "pos_1", "price"]),
        ("json_nested_tags", ("b", "items", "tags", None), ["root_id", "pos_1", "pos_2", "pos_3", "value"])):
    BINDINGS[_name] = _nested_table(_path, _columns)


def orders_by_key(spark, d) -> DataFrame:
    """Documents with order numbers as field names: one per customer and stretch
    of 64 order numbers, so none grows with a customer."""
    o = t(spark, d, "orders")
    once = (o.groupBy("o_custkey", "o_orderkey").agg(F.max(F.struct("o_totalprice", "o_orderstatus")).alias("v")))
    entry = F.struct(F.col("o_orderkey").cast("string"), F.struct(F.col("v.o_totalprice").alias("total"), F.col("v.o_orderstatus").alias("status")))
    return (once.groupBy("o_custkey", F.floor(F.col("o_orderkey") / 64).alias("stretch"))
                .agg(F.map_from_entries(F.collect_list(entry)).alias("by_order"))
                .select(F.concat_ws("-", "o_custkey", "stretch").alias("doc_key"), F.to_json(F.struct("by_order")).alias("payload")))


@binding("json_data_keys")
def _t11c(spark, d):
    tabs = J.json_to_tables(orders_by_key(spark, d), "payload", key_col="doc_key", max_fields=100)
    keys, values = tabs[("by_order",)], tabs[("by_order", "value")]
    # without its VARIANT a table looks small to the planner, which would gather all rows in the driver to broadcast them
    return keys.join(values.hint("merge"), ["root_id", "pos_1"]).select("root_id", "key", "total", "status")


@binding("infer_json_columns_nested")
def _t12b(spark, d):
    return J.infer_json_columns(nested_payloads(spark, d), "payload")


@binding("infer_json_columns")
def _t12(spark, d):
    return J.infer_json_columns(t(spark, d, "events"), "props")


# ------------------------------------------------------------- graph
def part_supplier_edges(spark, d) -> DataFrame:
    """Directed edges both ways between a part and each supplier that
    shipped it (supplier vertices are -1 - suppkey); weight = smallest
    quantity shipped on that pair."""
    li = t(spark, d, "lineitem")
    pairs = li.groupBy("l_partkey", "l_suppkey").agg(F.min("l_quantity").alias("w"))
    sv = (F.lit(-1) - F.col("l_suppkey"))
    return (pairs.select(F.col("l_partkey").alias("src"), sv.alias("dst"), "w")
                 .unionByName(pairs.select(sv.alias("src"), F.col("l_partkey").alias("dst"), "w")))


@binding("bfs_levels")
def _g01(spark, d):
    return G.bfs_levels(part_supplier_edges(spark, d), "src", "dst", start=0)


@binding("shortest_paths")
def _g02(spark, d):
    return G.shortest_paths(part_supplier_edges(spark, d), "src", "dst", "w", start=0)


@binding("shortest_paths_chain")
def _g02_chain(spark, d):
    """Every order linked both ways to the next one in time; weight = days
    between them plus one.  One chain of all orders, walked from the first."""
    o = t(spark, d, "orders").select("o_orderkey", "o_orderdate")
    at = global_positions(o, [F.col("o_orderdate"), F.col("o_orderkey")])
    to = at.select(F.col("o_orderkey").alias("dst"), F.col("o_orderdate").alias("then"), (F.col("position") - 1).alias("position"))
    links = at.join(to, "position").select(F.col("o_orderkey").alias("src"), "dst",
                                           (F.datediff("then", "o_orderdate") + 1).alias("w"))
    both = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    first = o.agg(F.min(F.struct("o_orderdate", "o_orderkey")).alias("f")).first()["f"]
    return G.shortest_paths(both, "src", "dst", "w", start=first and first["o_orderkey"])


# ------------------------------------------------------------- sources
@binding("read_table")
def _i01(spark, d):
    path = scratch_path(spark, "orders_by_priority")
    t(spark, d, "orders").write.partitionBy("o_orderpriority").parquet(path)
    return TB.read_table(spark, path, {"o_orderpriority": "1-URGENT", "o_custkey": 5},
                         where="o_totalprice > 100000")


@binding("dedup_partition")
def _a14(spark, d):
    path = scratch_path(spark, "lineitem_by_month")
    li = t(spark, d, "lineitem").withColumn(
        "ship_month", (F.year("l_shipdate") * 100 + F.month("l_shipdate")).cast("int"))
    li.write.partitionBy("ship_month").parquet(path)
    D.dedup_partition(spark, path, "ship_month", 199803, LINE_KEYS, LINE_ORDER,
                      staging_path=scratch_path(spark, "dedup_staging"))
    return spark.read.parquet(path)


@binding("ingest_full")
def _i04(spark, d):
    target = scratch_path(spark, IN.target_name("customer", "erp"))
    IN.ingest_full(t(spark, d, "customer"), target, drop_cols=["c_acctbal"], source="erp", table="customer")
    return spark.read.parquet(target)


@binding("ingest_compare")
def _i05(spark, d):
    """The reports of two runs: counts differ from a stale load (reload), then agree (skip)."""
    cust = t(spark, d, "customer")
    target = scratch_path(spark, IN.target_name("customer", "crm"))
    IN.ingest_full(cust.filter(F.col("c_nationkey") < 10), target)
    reports = [IN.ingest_compare(cust, target, source="crm", table="customer").withColumn("run", F.lit(k)) for k in (1, 2)]
    return reports[0].unionByName(reports[1]).select("run", "status", "records")


@binding("ingest_incremental")
def _i06(spark, d):
    """Two runs over a target that holds half of the rows at its mark and half of those without one."""
    o = t(spark, d, "orders").select("o_orderkey", "o_totalprice",
                                     F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderdate")).alias("changed_at"))
    mark = F.lit("1998-01-02").cast("timestamp_ntz")
    w = F.col("changed_at")
    old = o.filter((w < mark) | ((w == mark) & (F.col("o_orderkey") % 2 == 0)) | (w.isNull() & (F.col("o_orderkey") % 100 == 0)))
    target = scratch_path(spark, IN.target_name("orders", "erp"))
    IN.ingest_full(old, target)
    for _ in range(2):  # the second run finds nothing new
        IN.ingest_incremental(o, target, "changed_at", source="erp", table="orders")
    return spark.read.parquet(target)


@binding("ingest_merge")
def _i07(spark, d):
    """Changed orders arrive twice (the later status loses) and some move to another partition."""
    o = t(spark, d, "orders")
    target = scratch_path(spark, IN.target_name("orders", "merge"))
    IN.ingest_full(o, target, partition_by=["o_orderpriority"])
    moved = F.when(F.col("o_totalprice") > 400000, "1-URGENT").otherwise(F.col("o_orderpriority"))
    changed = o.filter(F.col("o_totalprice") > 300000).withColumn("o_orderpriority", moved)
    incoming = changed.withColumn("o_orderstatus", F.lit("Z")).unionByName(changed.withColumn("o_orderstatus", F.lit("X")))
    IN.ingest_merge(incoming, target, "o_orderkey", staging=scratch_path(spark, "merge_staging"),
                    partition_by=["o_orderpriority"], tie_break="o_orderstatus")
    return spark.read.parquet(target).select(*o.columns)


@binding("copy_table_if_absent")
def _i08(spark, d):
    src = scratch_path(spark, "lineitem_by_flag")
    t(spark, d, "lineitem").write.partitionBy("l_returnflag").parquet(src)
    target = scratch_path(spark, "lineitem_copy")
    FS.copy_table_if_absent(spark, src, target)
    FS.copy_table_if_absent(spark, src, target)  # second call: target exists, untouched
    return spark.read.parquet(target)


def event_log_lines(spark, d) -> DataFrame:
    """A text log derived from events: one entry per event; error events
    carry a two-line stack trace."""
    ev = t(spark, d, "events")
    level = (F.when(F.col("event_type") == "error", "ERROR")
              .when(F.col("event_type") == "purchase", "WARNING").otherwise("INFO"))
    first = F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"), level,
                        F.concat(F.lit("app."), F.col("event_type")),
                        F.concat(F.lit("user "), F.col("user_id").cast("string"),
                                 F.lit(" event "), F.col("event_id").cast("string")))
    trace = F.concat(F.lit("\nTraceback (most recent call last):\nValueError: event "),
                     F.col("event_id").cast("string"))
    text = F.when(F.col("event_type") == "error", F.concat(first, trace)).otherwise(first)
    return ev.select(F.col("user_id"), F.col("ts"), text.alias("value"))


@binding("parse_log")
def _i09(spark, d):
    path = scratch_path(spark, "app_log")
    event_log_lines(spark, d).repartitionByRange("user_id", "ts").sortWithinPartitions("user_id", "ts").select("value").write.text(path)
    out = LG.parse_log(spark, path, run_id="r1", env="test", notebook="events")
    return out.select("Log_Date", "Level", "Logger", "Message", "Exception_Message", "Stack_Trace",
                      "Raw_Line")


def _audited(lines) -> dict:
    """A caller's own parser: users and events as numbers; purchases by user 0
    modulo 7 cannot be parsed."""
    first = F.element_at(lines, 1)
    number = lambda word: F.regexp_extract(first, word + r" (\d+)", 1)
    bad = first.contains(" app.purchase ") & (number("user").cast("long") % 7 == 0)
    return {"Level": F.lower(F.split(first, " ")[2]), "Logger": F.concat(F.lit("user-"), number("user")),
            "Message": number("event"), "parse_error": F.when(bad, F.concat(F.lit("event "), number("event")))}


@binding("persist_log")
def _i09b(spark, d):
    """Two runs over one log, the first of them repeated."""
    path, target = scratch_path(spark, "app_log"), scratch_path(spark, "app_audit")
    event_log_lines(spark, d).repartitionByRange("user_id", "ts").sortWithinPartitions("user_id", "ts").select("value").write.text(path)
    for run in ("01", "a:b/c", "01"):
        LG.persist_log(spark, path, target, run, env="test", parser=_audited)
    return LG.read_audit(spark, target).select("Env", "Run_ID", "Log_Date", "Level", "Logger", "Message", "Raw_Line")


# ------------------------------------- partition values that are no plain words
def _odd_partitions(df: DataFrame, k) -> DataFrame:
    """``p``: numbers with a leading zero, characters that paths escape, NULL;
    ``q``: nothing but numbers with a leading zero."""
    names = ["01", "1", "a:b", "x/y", "a=b", "2024-01-02", None]
    p = F.element_at(F.array(*[F.lit(x) for x in names]), (k % 7 + 1).cast("int"))
    return df.withColumns({"p": p, "q": F.lpad((k % 3).cast("string"), 2, "0")})


@binding("dedup_partition_values")
def _a14b(spark, d):
    path = scratch_path(spark, "orders_odd")
    _odd_partitions(t(spark, d, "orders"), F.col("o_orderkey")).write.partitionBy("q").parquet(path)
    D.dedup_partition(spark, path, "q", "01", "o_custkey", ["o_orderdate", "o_orderkey"], staging_path=scratch_path(spark, "odd_staging"))
    return TB.read_layout(spark, path).select("o_orderkey", "o_custkey", "p", "q")


@binding("ingest_merge_values")
def _i07b(spark, d):
    """Dear orders move to the partitions of the next key, the others of their partition stay."""
    o = t(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    target = scratch_path(spark, "orders_odd")
    IN.ingest_full(_odd_partitions(o, F.col("o_orderkey")), target, partition_by=["p", "q"])
    dear = _odd_partitions(o.filter("o_totalprice > 300000"), F.col("o_orderkey") + 1).withColumn("o_orderstatus", F.lit("M"))
    # all of one partition leaves it
    left = _odd_partitions(o.filter("o_orderkey % 21 = 3"), F.lit(0)).withColumn("o_orderstatus", F.lit("L"))
    IN.ingest_merge(dear.filter("o_orderkey % 21 <> 3").unionByName(left), target, "o_orderkey",
                    staging=scratch_path(spark, "odd_merge"), partition_by=["p", "q"])
    return TB.read_layout(spark, target).select("o_orderkey", "o_orderstatus", "p", "q")


@binding("compact_table_values")
def _i11b(spark, d):
    """A copy, one partition of it compacted in place, and all values of its folders."""
    src, copy = scratch_path(spark, "orders_odd"), scratch_path(spark, "orders_odd_copy")
    o = t(spark, d, "orders").select("o_orderkey", "o_totalprice")
    _odd_partitions(o, F.col("o_orderkey")).write.partitionBy("q", "p").parquet(src)
    FS.copy_table_if_absent(spark, src, copy)
    FS.compact_table(spark, copy, scratch_path(spark, "odd_compact"), target_mb=64, where="q = '01' AND p = 'x/y'")
    return TB.read_layout(spark, copy).select("o_orderkey", "o_totalprice", "p", "q")


@binding("convert_format")
def _i10(spark, d):
    as_json = scratch_path(spark, "orders_json")
    as_parquet = scratch_path(spark, "orders_parquet")
    FS.convert_format(spark, table_path(d, "orders"), as_json, "parquet", "json")
    schema = t(spark, d, "orders").schema
    return FS.convert_format(spark, as_json, as_parquet, "json", "parquet", schema=schema)


@binding("compact_table")
def _i11(spark, d):
    small = scratch_path(spark, "lineitem_small_files")
    t(spark, d, "lineitem").repartition(16).write.parquet(small)
    out = scratch_path(spark, "lineitem_compacted")
    FS.compact_table(spark, small, out, target_mb=1, cluster_by=["l_partkey", "l_suppkey"], zorder=True)
    return spark.read.parquet(out)


# ------------------------------------------------------------- streaming
@binding("session_summary_stream")
def _a22(spark, d):
    src = scratch_path(spark, "events_stream_src")
    ev = t(spark, d, "events")
    ev.write.parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    sink, ckpt = scratch_path(spark, "sessions_sink"), scratch_path(spark, "sessions_ckpt")
    q = (SS.session_summary_stream(stream, "user_id", "ts", gap="30 minutes", watermark="10 minutes")
         .writeStream.format("parquet").option("path", sink).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink)


@binding("merge_insert_new_stream")
def _a23(spark, d):
    """Two runs.  The first has other, earlier rows of some keys; the second
    repeats every key and brings new ones, some of them nine days late."""
    ev = t(spark, d, "events").select("event_id", "user_id", "ts", "value")
    k, shift = F.col("event_id"), lambda by: (F.col("ts") + F.expr(by)).alias("ts")
    first = ev.filter(k % 3 != 0)
    earlier = first.filter(k % 5 == 0).withColumn("ts", shift("INTERVAL '-1' HOUR")).withColumn("value", F.col("value") - 1)
    again = ev.withColumn("value", F.col("value") + 1000)
    late = again.filter((k % 3 == 0) & (k % 2 == 0)).withColumn("ts", shift("INTERVAL '-9' DAY"))
    src, target = scratch_path(spark, "events_stream_src"), scratch_path(spark, "events_target")
    ckpt = scratch_path(spark, "events_merge_ckpt")
    for rows in (first.unionByName(earlier), again.withColumn("ts", shift("INTERVAL '1' DAY")).unionByName(late)):
        rows.write.mode("append").parquet(src)
        stream = spark.readStream.schema(ev.schema).parquet(src)
        SM.merge_insert_new_stream(stream, target, "event_id", "ts", checkpoint=ckpt).awaitTermination()
    return spark.read.parquet(target)
