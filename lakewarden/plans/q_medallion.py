"""Queries: sources, sinks, cleaned and gold tables, metrics, synthetic data, model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.functions.scalars import MONEY_SCALE, all_present, exact_avg, exact_sum, health_score
from lakewarden.operators import churn, classify, medallion, policy
from lakewarden.plans.entity_sql import sql_pick, with_entities
from lakewarden.plans.metrics import MetricSpec
from lakewarden.plans.registry import query
from lakewarden.session import shared_path, stage
from lakewarden.sources import entities as E
from lakewarden.sources import sinks, synth, tables

# The test tables and their columns.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
PRIMARY_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
    "part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"], "documents": ["doc_id"], "embeddings": ["vec_id"], "pages": ["page_id"],
    "benchmark": ["item_id"], "labels": ["doc_id"], "conversations": ["conv_id", "turn"],
}


def table_columns(name: str) -> list[tuple[str, str]]:
    return [tuple(c.split(" ")) for c in TABLES[name].split(", ")]


def union(dfs: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


def silver_c(spark, d, strict=True):
    return medallion.clean_customers(E.customers(spark, d), strict)


def silver_t(spark, d, **parts):
    return medallion.clean_transactions(E.transactions(spark, d, **parts))


def silver_i(spark, d):
    return medallion.clean_interactions(E.interactions(spark, d))


def totals(spark, d):
    valid = E.lines(spark, d).filter(all_present("transaction_id", "amount")).filter("amount >= 0")
    orders = tables.load(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"))
    return medallion.totals_by_parent(valid, orders, "l_orderkey")


def health(spark, d):
    return medallion.customer_health(silver_c(spark, d), totals(spark, d), silver_i(spark, d), MONEY_SCALE)


def revenue(spark, d, only_purchases=True):
    region = silver_c(spark, d).select("customer_id", "region")
    return medallion.revenue_summary(silver_t(spark, d, by_customer=region), only_purchases=only_purchases)


def all_column_counts(spark, d):
    return union([tables.column_counts(t, tables.load(spark, d, t)) for t in TABLES])


_COLUMN_COUNTS_SQL = " union all ".join(
    f"select '{t}' as table_name, '{c}' as column_name, '{dt}' as data_type, {i + 1} as ordinal, "
    f"(select count(*) from {t}) as n_rows, (select count({c}) from {t}) as filled_rows"
    for t in TABLES for i, (c, dt) in enumerate(table_columns(t)))


@query("silver_customers", with_entities("clean_c", "select * from clean_c"))
def _(spark, d):
    return silver_c(spark, d)


@query("silver_transactions", with_entities("clean_t", """
    select transaction_id, customer_id, cast(amount as double) as amount, currency, transaction_type,
      product_category, transaction_date from clean_t"""))
def _(spark, d):
    return silver_t(spark, d).withColumn("amount", F.col("amount").cast("double"))


@query("silver_interactions", with_entities("clean_i", "select * from clean_i"))
def _(spark, d):
    return silver_i(spark, d)


@query("transaction_totals", with_entities("totals", "select * from totals"))
def _(spark, d):
    return totals(spark, d)


@query("interaction_totals", with_entities("i_totals", "select * from i_totals"))
def _(spark, d):
    return medallion.interaction_totals(silver_i(spark, d), MONEY_SCALE)


@query("customer_health", with_entities("health", "select * from health"))
def _(spark, d):
    return health(spark, d)


@query("customer_health_v2", with_entities("health", """
    select customer_id, first_name, last_name, region, transaction_count as total_transactions,
      total_amount as total_spend, avg_sentiment, health_score from health"""))
def _(spark, d):
    return medallion.customer_health_v2(silver_c(spark, d), totals(spark, d), silver_i(spark, d), MONEY_SCALE)


@query("revenue_summary", with_entities("revenue", "select * from revenue"))
def _(spark, d):
    return revenue(spark, d)


@query("revenue_summary_all", with_entities("revenue_all", "select * from revenue_all"))
def _(spark, d):
    return revenue(spark, d, only_purchases=False)


@query("row_counts", with_entities("clean_c clean_t clean_i totals", """
    select 'cleaned_customers' as table_name, count(*) as row_count from clean_c
    union all select 'cleaned_transactions', count(*) from clean_t
    union all select 'cleaned_interactions', count(*) from clean_i
    union all select 'transaction_totals', count(*) from totals"""))
def _(spark, d):
    return medallion.row_counts({
        "cleaned_customers": silver_c(spark, d),
        "cleaned_transactions": silver_t(spark, d, category=False),
        "cleaned_interactions": silver_i(spark, d),
        "transaction_totals": totals(spark, d),
    }).orderBy("table_name")


@query("avg_by_type_category", with_entities("clean_t", """
    select transaction_type, product_category, cast(sum(amount) as double) / count(amount) as avg_amount
    from clean_t where transaction_type = 'purchase' and product_category = 'PROMO' group by all"""))
def _(spark, d):
    hit = (F.col("transaction_type") == "purchase") & (F.col("product_category") == "PROMO")
    return silver_t(spark, d).filter(hit).groupBy("transaction_type", "product_category").agg(
        exact_avg("amount").alias("avg_amount"))


@query("distribution", with_entities("clean_t clean_c", """
    select 'transaction_type' as column_name, transaction_type as value, count(*) as n_rows from clean_t group by all
    union all select 'currency', currency, count(*) from clean_t group by all
    union all select 'region', region, count(*) from clean_c group by all"""))
def _(spark, d):
    t = silver_t(spark, d, category=False)
    return union([medallion.distribution(t, "transaction_type"), medallion.distribution(t, "currency"),
                  medallion.distribution(silver_c(spark, d), "region")])


@query("value_ranges", with_entities("clean_t clean_i", """
    select 'amount' as column_name, cast(min(amount) as double) as lowest, cast(max(amount) as double) as highest,
      count(*) filter (amount < 0) as n_negative from clean_t
    union all select 'sentiment_score', min(sentiment_score), max(sentiment_score),
      count(*) filter (sentiment_score < 0) from clean_i"""))
def _(spark, d):
    def ranges(df, col):
        return df.agg(F.min(col).cast("double").alias("lowest"), F.max(col).cast("double").alias("highest"),
                      F.count_if(F.col(col) < 0).alias("n_negative")).select(
            F.lit(col).alias("column_name"), "lowest", "highest", "n_negative")

    return ranges(silver_t(spark, d, category=False), "amount").unionByName(
        ranges(silver_i(spark, d), "sentiment_score"))


@query("health_score", """
    select o_orderkey as id, round(((cast(('0x' || substr(md5(cast(o_orderkey as varchar)), 1, 16)) as ubigint)::hugeint
      % 1000 * 616 + cast(('0x' || substr(md5(cast(o_orderkey as varchar)), 17, 16)) as ubigint)::hugeint % 1000)
      % 1000)::double / 10, 1) as health_score from orders""")
def _(spark, d):
    return tables.load(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), health_score("o_orderkey").alias("health_score"))


@query("segment_slice", with_entities("clean_c", """
    select customer_id, left(email, 2) || '****' as email, region, 'segment_a' as segment
    from clean_c where region = 'EUROPE' order by customer_id limit 100"""))
def _(spark, d):
    visible = policy.row_filter(silver_c(spark, d), "region", ["EUROPE"], False)
    secured = policy.mask_columns(visible, ["email"], False)
    return medallion.segment(secured, "segment_a", 100)


# Metrics

# The names and expressions of the metric definition.
METRICS = MetricSpec.from_yaml("""
source: revenue_summary
dimensions:
  - name: region
    expr: region
  - name: product_category
    expr: product_category
  - name: month
    expr: month
measures:
  - name: total_revenue
    expr: SUM(total_revenue)
  - name: avg_transaction_value
    expr: AVG(avg_transaction_value)
  - name: transaction_count
    expr: SUM(transaction_count)
  - name: weighted_transaction_value
    expr: SUM(total_revenue) / SUM(transaction_count)
""")


def rounded(df):
    """Sums of doubles depend on the order of rows in their last digits."""
    return df.withColumns({c: F.round(c, 4) for c, t in df.dtypes if t == "double"})


_AVG = "round(avg(avg_transaction_value), 4) as avg_transaction_value"
_SUM = "round(sum(total_revenue), 4) as total_revenue"
_N = "cast(sum(transaction_count) as bigint) as transaction_count"


@query("metric_by_region", with_entities("revenue_all", f"select region, {_SUM}, {_N} from revenue_all group by all"))
def _(spark, d):
    return rounded(METRICS.query(revenue(spark, d, False), ["region"], ["total_revenue", "transaction_count"]))


@query("metric_by_category_month", with_entities("revenue_all", f"""
    select product_category, month, {_SUM}, {_AVG} from revenue_all group by all"""))
def _(spark, d):
    return rounded(METRICS.query(
        revenue(spark, d, False), ["product_category", "month"], ["total_revenue", "avg_transaction_value"],
        order_by=["month", "product_category"]))


@query("metric_cube", with_entities("revenue_all", f"""
    select region, product_category, month, cast(grouping_id(region, product_category, month) as bigint) as grain,
      {_SUM}, {_N} from revenue_all group by cube (region, product_category, month)"""))
def _(spark, d):
    return rounded(METRICS.cube(
        revenue(spark, d, False), ["region", "product_category", "month"], ["total_revenue", "transaction_count"]))


@query("metric_weighted", with_entities("revenue_all", f"""
    select product_category, {_AVG},
      round(sum(total_revenue) / sum(transaction_count), 4) as weighted_transaction_value
    from revenue_all group by all"""))
def _(spark, d):
    return rounded(METRICS.query(
        revenue(spark, d, False), ["product_category"], ["avg_transaction_value", "weighted_transaction_value"]))


# Sources and sinks


@query("csv_roundtrip", with_entities("clean_c", """
    select region, count(*) as n_customers, count(distinct email) as n_emails, min(created_date) as first_created,
      max(phone) as last_phone from clean_c group by region"""))
def _(spark, d):
    path = shared_path(spark, "csv")
    sinks.write_csv(silver_c(spark, d), path)
    return tables.read_bronze(spark, path, tables.CUSTOMERS_CSV).groupBy("region").agg(
        F.count(F.lit(1)).alias("n_customers"), F.count_distinct("email").alias("n_emails"),
        F.min("created_date").alias("first_created"), F.max("phone").alias("last_phone"))


@query("publish_roundtrip", with_entities("totals", """
    select count(*) as n_customers, cast(sum(total_transactions) as bigint) as n_transactions,
      cast(sum(cast(total_amount as decimal(18,4))) as double) as total_amount from totals"""))
def _(spark, d):
    path = shared_path(spark, "publish")
    sinks.publish(totals(spark, d), path)
    again = sinks.publish(totals(spark, d), path)
    return again.agg(F.count(F.lit(1)).alias("n_customers"), F.sum("total_transactions").alias("n_transactions"),
                     exact_sum("total_amount").alias("total_amount"))


@query("file_inventory", " union all ".join(
    f"select '{t}' as table_name, count(*) as n_rows, true as has_size from {t}" for t in TABLES))
def _(spark, d):
    inventory = union([
        tables.file_inventory(tables.load(spark, d, t)).withColumn("table_name", F.lit(t)) for t in TABLES])
    return inventory.groupBy("table_name").agg(
        F.sum("n_rows").alias("n_rows"), (F.min("file_size") > 0).alias("has_size"))


@query("cluster_layout")
def _(spark, d):
    path = shared_path(spark, "cluster")
    laid = sinks.cluster_layout(revenue(spark, d, False), ["region", "product_category"], path, rows_per_file=400)
    return laid.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("region").alias("first_region"), F.max("region").alias("last_region"))


@query("cluster_layout_facts", with_entities("revenue_all", """
    select count(*) as n_rows, cast(0 as bigint) as unsorted_rows, cast(0 as bigint) as overlapping_files,
      cast(ceil(count(*) / 400.0) as bigint) as most_files from revenue_all"""))
def _(spark, d):
    path, keys = shared_path(spark, "cluster"), ["region", "product_category"]
    laid = sinks.cluster_layout(revenue(spark, d, False), keys, path, rows_per_file=400)
    key = F.struct(*keys)
    # Within a file by the place of the row; a file holds a bounded number of rows.
    placed = laid.select(key.alias("key"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    files = placed.withColumn("late", (before > F.col("key")).cast("int")).groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("late"), F.lit(0)).alias("late"), F.min("key").alias("low"), F.max("key").alias("high"))
    files = files.withColumn("over", (F.lag("high").over(Window.orderBy("low", "high")) > F.col("low")).cast("int"))
    return files.agg(
        F.sum("n").alias("n_rows"), F.sum("late").cast("bigint").alias("unsorted_rows"),
        F.coalesce(F.sum("over"), F.lit(0)).cast("bigint").alias("overlapping_files"),
        F.greatest(F.count(F.lit(1)), F.ceil(F.sum("n") / 400.0)).cast("bigint").alias("most_files"))


@query("curve_layout_facts", with_entities("revenue_all", """
    select count(*) as n_rows, true as fewer_files_for_a_month, true as skips_by_region from revenue_all"""))
def _(spark, d):
    table, keys = stage(revenue(spark, d, False), "revenue"), ["region", "product_category", "month"]

    def files(laid):
        one_region = (F.min("region") == F.max("region")).cast("int")
        months = F.months_between(F.max("month"), F.min("month")) + 1
        return laid.groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.count(F.lit(1)).alias("n"), one_region.alias("one_region"), months.alias("months")).agg(
            F.sum("n").alias("n"), F.sum("months").alias("months"), F.sum("one_region").alias("one_region"))

    lexical = files(sinks.cluster_layout(table, keys, shared_path(spark, "cluster"), rows_per_file=100)).first()  # one row
    curve = files(sinks.curve_layout(table, keys, shared_path(spark, "curve"), rows_per_file=100))
    return curve.select(F.col("n").alias("n_rows"), (F.col("months") < lexical["months"]).alias("fewer_files_for_a_month"),
                        (F.col("one_region") > 0).alias("skips_by_region"))


@query("meta_columns", _COLUMN_COUNTS_SQL)
def _(spark, d):
    return all_column_counts(spark, d)


_RULE_SQL = "case " + " ".join(
    f"when regexp_matches(lower(column_name), '{p}') then '{label}'" for p, label in classify.NAME_RULES
) + f" else '{classify.OTHER_LABEL}' end"


@query("classify_columns", f"""
    select table_name, column_name, filled_rows, {_RULE_SQL} as classification from ({_COLUMN_COUNTS_SQL})""")
def _(spark, d):
    return classify.classify_names(all_column_counts(spark, d)).select(
        "table_name", "column_name", "filled_rows", "classification")


@query("column_docs", f"""
    select table_name, column_name, 'Column ' || column_name || ' of table ' || table_name || ' holds ' || data_type
      || ' values in ' || filled_rows || ' of ' || n_rows || ' rows.' as description from ({_COLUMN_COUNTS_SQL})""")
def _(spark, d):
    return classify.describe_columns(all_column_counts(spark, d))


# Synthetic entities: one per row of a given table


def _sql_draw(salt: str, key: str = "i") -> str:
    return f"cast('0x' || substr(md5(cast({key} as varchar) || ':{salt}'), 1, 15) as bigint)"


def _sql_uuid(n: str) -> str:
    digits = f"lpad(lower(hex({n})), 16, '0')"
    return f"'00000000-0000-0000-' || substr({digits}, 1, 4) || '-' || substr({digits}, 5, 12)"


def _sql_date(salt: str) -> str:
    return f"date '2022-01-01' + cast({_sql_draw(salt)} % {synth.DATE_SPAN} as int)"


def _sql_draw_pick(salt: str, values: list[str]) -> str:
    return sql_pick(_sql_draw(salt), values)


def _ids(spark, d, table, key):
    return tables.load(spark, d, table).select(F.col(key).alias("i"))


@query("synth_customers", f"""
    select {_sql_uuid('i + 1')} as customer_id, {_sql_draw_pick('given', synth.GIVEN)} as first_name,
      {_sql_draw_pick('family', synth.FAMILY)} as last_name,
      lower({_sql_draw_pick('given', synth.GIVEN)}) || {_sql_draw_pick('sep', synth.SEPARATORS)}
        || lower({_sql_draw_pick('family', synth.FAMILY)})
        || case when {_sql_draw('has_suffix')} % 10 < 4 then cast({_sql_draw('suffix')} % 999 + 1 as varchar)
           else '' end || '@example.com' as email,
      '(' || ({_sql_draw('area')} % 800 + 200) || ') ' || lpad(cast({_sql_draw('mid')} % 1000 as varchar), 3, '0')
        || '-' || lpad(cast({_sql_draw('end')} % 10000 as varchar), 4, '0') as phone,
      ({_sql_draw('house')} % 9999 + 1) || ' ' || {_sql_draw_pick('street', synth.TOWNS)} || ' Street'
        as street_address,
      {_sql_draw_pick('town', synth.TOWNS)} as city, {_sql_draw_pick('state', synth.FAMILY)} as state,
      {_sql_draw_pick('land', synth.LANDS)} as country, {_sql_draw_pick('region', synth.REGIONS)} as region,
      {_sql_date('created')} as created_date
    from (select c_custkey as i from customer)""")
def _(spark, d):
    return synth.synth_customers(_ids(spark, d, "customer", "c_custkey"))


@query("synth_transactions", f"""
    select {_sql_uuid(f'i + {synth.TRANSACTION_OFFSET}')} as transaction_id,
      {_sql_uuid(f"{_sql_draw('customer')} % (select count(*) from customer) + 1")} as customer_id,
      ({_sql_draw('amount')} % 499901 + 100)::double / 100 as amount,
      {_sql_draw_pick('currency', synth.CURRENCIES)} as currency,
      {_sql_draw_pick('type', synth.TRANSACTION_TYPES)} as transaction_type,
      {_sql_draw_pick('category', synth.PRODUCT_CATEGORIES)} as product_category,
      {_sql_date('date')} as transaction_date
    from (select o_orderkey as i from orders)""")
def _(spark, d):
    n = tables.load(spark, d, "customer").count()
    return synth.synth_transactions(_ids(spark, d, "orders", "o_orderkey"), n)


@query("synth_interactions", f"""
    select {_sql_uuid(f'i + {synth.INTERACTION_OFFSET}')} as interaction_id,
      {_sql_uuid(f"{_sql_draw('customer')} % (select count(*) from customer) + 1")} as customer_id,
      {_sql_draw_pick('channel', synth.CHANNELS)} as channel,
      {_sql_draw_pick('type', synth.INTERACTION_TYPES)} as interaction_type,
      ({_sql_draw('sentiment')} % 10001)::double / 10000 as sentiment_score,
      {_sql_date('date')} as interaction_date
    from (select event_id as i from events)""")
def _(spark, d):
    n = tables.load(spark, d, "customer").count()
    return synth.synth_interactions(_ids(spark, d, "events", "event_id"), n)


# Model


@query("churn_features", with_entities("health", """
    select customer_id, transaction_count, total_amount, interaction_count, avg_sentiment,
      cast(health_score < 50 as int) as churned from health"""))
def _(spark, d):
    return medallion.churn_features(health(spark, d))


@query("churn_scores")
def _(spark, d):
    features = stage(medallion.churn_features(health(spark, d)), "features")
    return churn.score_churn(churn.train_churn(features), features)


@query("churn_facts", with_entities("health", """
    select cast(health_score < 50 as int) as churned, count(*) as n_rows, cast(0 as bigint) as out_of_bounds,
      cast(0 as bigint) as against_probability from health group by all"""))
def _(spark, d):
    features = stage(medallion.churn_features(health(spark, d)), "features")
    p = F.col("churn_probability")
    return churn.score_churn(churn.train_churn(features), features).groupBy("churned").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~p.between(0, 1) | F.isnan(p)).alias("out_of_bounds"),
        F.count_if((F.col("predicted") == 1) != (p > 0.5)).alias("against_probability"))
