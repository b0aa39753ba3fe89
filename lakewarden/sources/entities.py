"""The entities of the data model, mapped from the star-schema tables.

Transactions keep every line item: order and part are attached by left joins, so a consumer that
needs neither leaves the join out and gets the same rows.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.functions.scalars import MONEY, pick
from lakewarden.sources.synth import CURRENCIES, INTERACTION_TYPES
from lakewarden.sources.tables import load

# Column names used for column-level metadata, in the order of l_linenumber.
COLUMN_NAMES = ["email", "phone", "street_address", "first_name", "last_name", "city", "region"]
PII_COLUMNS = ["email", "phone", "street_address"]
OBJECT_TYPES = ["table", "view", "function", "model", "volume"]
GOVERNED_VALUES = {
    "pii": ["true", "false"],
    "sensitivity_level": ["high", "medium", "low"],
    "domain": ["analytics", "sales", "support"],
    "certification": ["certified", "deprecated"],
}
TAG_VALUES = {
    "pii": ["true", "false"],
    "sensitivity_level": ["high", "medium", "low", "hgh"],
    "domain": ["analytics", "Analytics", "sales", "Sales ", "support"],
    "certification": ["certified", "deprecated", "uncertified"],
}


def nations(spark: SparkSession, d: str) -> DataFrame:
    nation, region = load(spark, d, "nation"), load(spark, d, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name")


def customers(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    joined = load(spark, d, "customer").join(nations(spark, d), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        k.alias("customer_id"),
        F.substring_index("c_name", "#", 1).alias("first_name"),
        F.substring_index("c_name", "#", -1).alias("last_name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
        F.concat(
            F.lit("("), (k % 800 + 200).cast("string"),
            F.lit(") "), F.lpad((k * 7919 % 1000).cast("string"), 3, "0"),
            F.lit("-"), F.lpad((k * 104729 % 10000).cast("string"), 4, "0"),
        ).alias("phone"),
        F.concat((k % 999 + 1).cast("string"), F.lit(" Market Street")).alias("street_address"),
        F.concat(F.lit("City "), (k % 97).cast("string")).alias("city"),
        F.concat(F.lit("State "), F.col("c_nationkey").cast("string")).alias("state"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
        F.date_add(F.lit("2022-01-01").cast("date"), (k % 731).cast("int")).alias("created_date"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )


def _amount() -> Column:
    return (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast(MONEY)


def lines(spark: SparkSession, d: str) -> DataFrame:
    """Line items in the shape of transactions, before order and part are attached."""
    return load(spark, d, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
        .alias("transaction_id"),
        _amount().alias("amount"),
        pick(F.col("l_suppkey"), CURRENCIES).alias("currency"),
        F.when(F.col("l_returnflag") == "R", "refund").otherwise("purchase").alias("transaction_type"),
        F.col("l_shipdate").cast("date").alias("transaction_date"),
    )


def transactions(spark: SparkSession, d: str, category: bool = True, customer: bool = True,
                 by_customer: DataFrame | None = None) -> DataFrame:
    """``by_customer`` adds its columns and keeps its customers only. It is joined to the orders, so
    the far larger line items are not shuffled once more for it."""
    df = lines(spark, d)
    names = ["transaction_id", "customer_id", "amount", "currency", "transaction_type",
             "product_category", "transaction_date"]
    if customer:
        orders = load(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"))
        if by_customer is not None:
            orders = orders.join(by_customer, "customer_id")
            names += [c for c in by_customer.columns if c != "customer_id"]
        how = "left" if by_customer is None else "inner"
        df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), how).drop("o_orderkey")
    if category:
        part = load(spark, d, "part").select("p_partkey", F.col("p_type").alias("product_category"))
        df = df.join(part, F.col("l_partkey") == F.col("p_partkey"), "left").drop("p_partkey")
    return df.select(*[n for n in names if n in df.columns])


def interactions(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events").select(
        F.col("event_id").alias("interaction_id"),
        F.col("user_id").alias("customer_id"),
        F.col("event_type").alias("channel"),
        pick(F.col("event_id"), INTERACTION_TYPES).alias("interaction_type"),
        F.col("value").alias("sentiment_score"),
        F.col("ts").cast("date").alias("interaction_date"),
    )


def assets(spark: SparkSession, d: str) -> DataFrame:
    """Governed objects: one per part."""
    return load(spark, d, "part").select(
        F.col("p_type").alias("catalog"),
        F.col("p_brand").alias("schema"),
        F.col("p_partkey").alias("object"),
        F.col("p_name").alias("name"),
        pick(F.col("p_size"), OBJECT_TYPES).alias("object_type"),
        F.concat_ws(" ", "p_type", "p_name", "p_brand").alias("comment"),
    )


def asset_columns(spark: SparkSession, d: str) -> DataFrame:
    """Seven columns per object."""
    names = F.array(*map(F.lit, COLUMN_NAMES))
    return assets(spark, d).select("catalog", "schema", "object", F.explode(names).alias("column_name"))


def members(spark: SparkSession, d: str) -> DataFrame:
    """Direct membership: each customer belongs to a segment group and a nation group."""
    customer = load(spark, d, "customer").join(
        load(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    groups = F.array(F.concat(F.lit("seg:"), "c_mktsegment"), F.concat(F.lit("nat:"), "n_name"))
    return customer.select(F.explode(groups).alias("grp"), F.col("c_name").alias("principal"))


def group_edges(spark: SparkSession, d: str) -> DataFrame:
    """Nested groups: a nation group is a member of its region group."""
    return nations(spark, d).select(
        F.concat(F.lit("nat:"), "n_name").alias("src"), F.concat(F.lit("reg:"), "r_name").alias("dst"))


def grant_log(spark: SparkSession, d: str) -> DataFrame:
    """Grants and revokes, one per order.

    The urgency picks the privilege, the status its level, the key the object and the grantee.
    """
    n_objects = load(spark, d, "part").count()
    customer = load(spark, d, "customer").join(nations(spark, d), F.col("c_nationkey") == F.col("n_nationkey"))
    k, priority, status = F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus")
    privilege = (
        F.when(priority == "1-URGENT", "USE CATALOG").when(priority == "2-HIGH", "USE SCHEMA").otherwise("SELECT"))
    level = (
        F.when(priority == "1-URGENT", "CATALOG")
        .when(priority == "2-HIGH", F.when(status == "P", "CATALOG").otherwise("SCHEMA"))
        .when(priority == "3-MEDIUM", F.when(status == "P", "CATALOG").otherwise("SCHEMA"))
        .otherwise("TABLE"))
    grantee = (
        F.when(k % 50 == 0, F.concat(F.lit("seg:"), "c_mktsegment"))
        .when(k % 50 == 1, F.concat(F.lit("nat:"), "n_name"))
        .when(k % 50 == 2, F.concat(F.lit("reg:"), "r_name"))
        .otherwise(F.col("c_name")))
    return (
        load(spark, d, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .withColumn("object", k % n_objects)
        .join(assets(spark, d).select("catalog", "schema", "object"), "object")
        .select(
            level.alias("securable_type"), "catalog",
            F.when(level != "CATALOG", F.col("schema")).alias("schema"),
            F.when(level == "TABLE", F.col("object")).alias("object"),
            grantee.alias("grantee"), privilege.alias("privilege"),
            F.when(status == "F", "REVOKE").otherwise("GRANT").alias("action"),
            F.col("o_orderdate").cast("date").alias("changed_on"), k.alias("seq"),
        )
    )


def owners(spark: SparkSession, d: str) -> DataFrame:
    """An object is owned by the customer with the same key, where there is one.

    A schema (object NULL) is owned by the owner of its smallest object, a catalog (schema NULL too) by
    the owner of its largest.
    """
    customer = load(spark, d, "customer").select(F.col("c_custkey").alias("object"), F.col("c_name").alias("owner"))
    named = assets(spark, d).select("catalog", "schema", "object").join(customer, "object")
    none = F.lit(None)
    schemas = named.groupBy("catalog", "schema").agg(F.min("object").alias("object")).join(customer, "object").select(
        none.cast("bigint").alias("object"), "catalog", "schema", "owner")
    catalogs = named.groupBy("catalog").agg(F.max("object").alias("object")).join(customer, "object").select(
        none.cast("bigint").alias("object"), "catalog", none.cast("string").alias("schema"), "owner")
    return named.unionByName(schemas).unionByName(catalogs)


def domain_claims(spark: SparkSession, d: str) -> DataFrame:
    """A domain (region) claims the parts that its suppliers deliver; each claim once."""
    suppliers = load(spark, d, "supplier").join(nations(spark, d), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("r_name").alias("domain"))
    claimed = load(spark, d, "lineitem").join(suppliers, "l_suppkey").select(
        "domain", F.col("l_partkey").alias("object")).distinct()
    return claimed.join(assets(spark, d).select("catalog", "schema", "object"), "object")


def domain_roles(spark: SparkSession, d: str) -> DataFrame:
    """Technical and business owner of each domain: its first and last supplier by name."""
    return load(spark, d, "supplier").join(nations(spark, d), F.col("s_nationkey") == F.col("n_nationkey")).groupBy(
        F.col("r_name").alias("domain")).agg(
        F.min("s_name").alias("technical_owner"), F.max("s_name").alias("business_owner"))


def usage(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events").select(
        F.col("event_type").alias("sku_name"),
        F.when(F.col("event_type") == "purchase", "HOURS").otherwise("GB").alias("usage_unit"),
        F.col("value").alias("usage_quantity"),
        F.col("ts").cast("date").alias("usage_date"),
        F.col("user_id").alias("principal"),
    )


def tag_log(spark: SparkSession, d: str) -> DataFrame:
    """Tag changes on object columns, one per line item."""
    names = list(TAG_VALUES)
    slot = F.col("l_quantity").cast("bigint")
    name = pick(slot, names)
    value = F.lit(None).cast("string")
    for n in names:
        value = F.when(name == n, pick(F.col("l_suppkey"), TAG_VALUES[n])).otherwise(value)
    return load(spark, d, "lineitem").select(
        F.col("l_partkey").alias("object"),
        pick(F.col("l_linenumber") - 1, COLUMN_NAMES).alias("column_name"),
        name.alias("tag_name"),
        value.alias("tag_value"),
        F.when(F.col("l_returnflag") == "R", "UNSET").otherwise("SET").alias("action"),
        F.col("l_shipdate").cast("date").alias("changed_on"),
        F.col("l_orderkey").alias("seq"),
    )


def named_tags(tags: DataFrame, spark: SparkSession, d: str) -> DataFrame:
    """Tags with the full name of their object, attached after the log is reduced."""
    return tags.join(assets(spark, d).select("catalog", "schema", "object"), "object")


def _days(df: DataFrame, col: str, window: tuple[date, date] | None) -> DataFrame:
    """Rows of the days from first to last, as a range of the stored timestamp, which reaches the scan."""
    if window is None:
        return df
    first, last = (F.lit(datetime.combine(x, time())).cast("timestamp_ntz") for x in (window[0], window[1] + timedelta(1)))
    return df.filter((F.col(col) >= first) & (F.col(col) < last))


def table_events(spark: SparkSession, d: str, window: tuple[date, date] | None = None) -> DataFrame:
    """Table lineage as it was observed: supplier -> part -> order -> customer, one row per event.

    ``window`` keeps the events of these days, both included.
    """
    line = _days(load(spark, d, "lineitem"), "l_shipdate", window).select(
        F.concat(F.lit("supplier:"), "l_suppkey").alias("s"),
        F.concat(F.lit("part:"), "l_partkey").alias("p"),
        F.concat(F.lit("order:"), "l_orderkey").alias("o"),
        F.col("l_shipdate").cast("date").alias("event_date"),
    )
    pairs = F.array(
        F.struct(F.col("s").alias("source_table_full_name"), F.col("p").alias("target_table_full_name"),
                 F.lit("TABLE").alias("entity_type")),
        F.struct(F.col("p").alias("source_table_full_name"), F.col("o").alias("target_table_full_name"),
                 F.lit("VIEW").alias("entity_type")),
    )
    from_lines = line.select("event_date", F.inline(pairs))
    from_orders = _days(load(spark, d, "orders"), "o_orderdate", window).select(
        F.col("o_orderdate").cast("date").alias("event_date"),
        F.concat(F.lit("order:"), "o_orderkey").alias("source_table_full_name"),
        F.concat(F.lit("customer:"), "o_custkey").alias("target_table_full_name"),
        F.lit("TABLE").alias("entity_type"),
    )
    return from_lines.unionByName(from_orders)


def table_edges(spark: SparkSession, d: str) -> DataFrame:
    """One row per edge with its newest event."""
    return table_events(spark, d).groupBy("source_table_full_name", "target_table_full_name", "entity_type").agg(
        F.max("event_date").alias("event_date"))


def column_events(spark: SparkSession, d: str, window: tuple[date, date] | None = None) -> DataFrame:
    """Column lineage as it was observed: part columns feed order columns (every other one renamed), which feed customer columns."""
    line = _days(load(spark, d, "lineitem"), "l_shipdate", window)
    name = pick(F.col("l_linenumber") - 1, COLUMN_NAMES)
    renamed = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("contact_"), name)).otherwise(name)
    part_to_order = line.select(
        F.concat(F.lit("part:"), "l_partkey").alias("source_table_full_name"),
        name.alias("source_column_name"),
        F.concat(F.lit("order:"), "l_orderkey").alias("target_table_full_name"),
        renamed.alias("target_column_name"),
        F.col("l_shipdate").cast("date").alias("event_date"),
    )
    order_to_customer = (
        line.filter(F.col("l_linestatus") == "O")
        .join(load(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.concat(F.lit("order:"), "l_orderkey").alias("source_table_full_name"),
            renamed.alias("source_column_name"),
            F.concat(F.lit("customer:"), "o_custkey").alias("target_table_full_name"),
            renamed.alias("target_column_name"),
            F.col("l_shipdate").cast("date").alias("event_date"),
        )
    )
    return part_to_order.unionByName(order_to_customer)
