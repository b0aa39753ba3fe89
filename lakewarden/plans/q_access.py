"""Queries: access, lineage, streaming."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from lakewarden.functions.scalars import MONEY_SCALE
from lakewarden.operators import access, classify, lineage, tags
from lakewarden.plans.entity_sql import with_entities
from lakewarden.plans.q_governance import _FAILED_SQL, _line_rules, _tags
from lakewarden.plans.q_medallion import silver_c, silver_i, silver_t
from lakewarden.plans.registry import query
from lakewarden.session import shared_path
from lakewarden.sources import entities as E
from lakewarden.sources.tables import load
from lakewarden.streaming import jobs

AS_OF = date(2001, 1, 1)
_RECENT = "event_date between date '2001-01-01' - 7 and date '2001-01-01'"
WINDOW = (AS_OF - timedelta(7), AS_OF)

# Access


def _memberships(spark, d):
    return access.expand_members(E.members(spark, d), E.group_edges(spark, d))


@query("access_audit", with_entities("net", """
    select securable_type, catalog, schema, object, grantee, privilege from net
    where schema in ('Brand#1', 'Brand#2', 'Brand#3')"""))
def _(spark, d):
    return access.access_audit(access.net_grants(E.grant_log(spark, d)), ["Brand#1", "Brand#2", "Brand#3"])


@query("net_grants", with_entities("grant_log", """
    select securable_type, catalog, schema, object, grantee, privilege from grant_log
    qualify row_number() over (partition by securable_type, catalog, schema, object, grantee, privilege
      order by changed_on desc, seq desc) = 1 and action = 'GRANT'"""))
def _(spark, d):
    return access.net_grants(E.grant_log(spark, d))


@query("effective_access", with_entities("uc us sel", """
    select catalog, count(*) as readable_pairs from sel
      join uc using (principal, catalog) join us using (principal, catalog, schema) group by catalog"""))
def _(spark, d):
    objects = E.assets(spark, d).select("catalog", "schema", "object")
    return access.effective_access(access.net_grants(E.grant_log(spark, d)), _memberships(spark, d), objects, E.owners(spark, d))


@query("access_gaps", with_entities("uc us sel", """
    select r.principal, r.catalog, r.schema, r.object, concat_ws(',',
        case when uc.principal is null then 'USE CATALOG' end, case when us.principal is null then 'USE SCHEMA' end,
        case when sel.principal is null then 'SELECT' end) as missing
    from req r left join uc on (r.principal, r.catalog) = (uc.principal, uc.catalog)
      left join us on (r.principal, r.catalog, r.schema) = (us.principal, us.catalog, us.schema)
      left join sel on (r.principal, r.object) = (sel.principal, sel.object)
    where uc.principal is null or us.principal is null or sel.principal is null""", extra="""
    req as (select distinct c_name as principal, catalog, schema, object from lineitem
      join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
      join assets on l_partkey = object)"""))
def _(spark, d):
    buyers = load(spark, d, "orders").join(
        load(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("c_name").alias("principal"))
    objects = E.assets(spark, d).select("catalog", "schema", "object")
    bought = load(spark, d, "lineitem").select("l_orderkey", F.col("l_partkey").alias("object")).join(
        buyers, "l_orderkey").join(objects, "object")
    return access.access_gaps(bought, access.net_grants(E.grant_log(spark, d)), _memberships(spark, d), objects, E.owners(spark, d))


@query("audit_rollup", """
    select user_id as principal, event_type as object, cast(ts as date) as day, count(*) as n_accesses,
      min(ts) as first_at, max(ts) as last_at from events group by all""")
def _(spark, d):
    return access.audit_rollup(load(spark, d, "events").select(
        F.col("user_id").alias("principal"), F.col("event_type").alias("object"), F.col("ts").alias("at")))


@query("request_queue", """
    select c_mktsegment as owner, case o_orderstatus when 'P' then 'pending' when 'F' then 'approved' else 'denied' end
      as status, count(*) as n_requests, round(sum(case when o_orderstatus <> 'P' then
        date_diff('day', cast(o_orderdate as date), cast(decided as date)) end)::double
        / count(case when o_orderstatus <> 'P' then decided end), 6) as mean_days
    from orders join customer on o_custkey = c_custkey
      left join (select l_orderkey, max(l_shipdate) as decided from lineitem group by all) on l_orderkey = o_orderkey
    group by all""")
def _(spark, d):
    status = F.col("o_orderstatus")
    decided = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").cast("date").alias("last"))
    requests = (
        load(spark, d, "orders").join(decided, "o_orderkey", "left")
        .join(load(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("c_mktsegment").alias("owner"),
            F.when(status == "P", "pending").when(status == "F", "approved").otherwise("denied").alias("status"),
            F.col("o_orderdate").cast("date").alias("asked_on"),
            F.when(status != "P", F.col("last")).alias("decided_on"))
    )
    return access.request_queue(requests)


# Lineage


@query("direct_upstream", with_entities("recent_edges", """
    select source_table_full_name, target_table_full_name, entity_type, event_date from recent_edges
    where target_table_full_name in (select target_table_full_name from recent_edges
      where target_table_full_name like 'part:%' order by event_date desc, target_table_full_name limit 1)"""))
def _(spark, d):
    events = E.table_events(spark, d, WINDOW)
    # One table is asked for: the part with the newest event.
    latest = events.filter("target_table_full_name like 'part:%'").orderBy(
        F.col("event_date").desc(), "target_table_full_name").select("target_table_full_name").first()
    return lineage.upstream(events, latest[0], AS_OF)


@query("direct_downstream", with_entities("recent_edges", """
    select distinct target_table_full_name from recent_edges
    where source_table_full_name in (select source_table_full_name from recent_edges
      where source_table_full_name like 'part:%' order by event_date desc, source_table_full_name limit 1)"""))
def _(spark, d):
    events = E.table_events(spark, d, WINDOW)
    latest = events.filter("source_table_full_name like 'part:%'").orderBy(
        F.col("event_date").desc(), "source_table_full_name").select("source_table_full_name").first()
    return lineage.downstream(events, latest[0], AS_OF)


@query("impact_closure", with_entities("edges", """
    select node, min(depth) as depth from reach group by node""", extra="""
    reach as (select 'supplier:1' as node, 0 as depth
      union select target_table_full_name, depth + 1 from reach join edges on source_table_full_name = node)"""))
def _(spark, d):
    root = load(spark, d, "supplier").filter("s_suppkey = 1").select(
        F.concat(F.lit("supplier:"), "s_suppkey").alias("node"))
    return lineage.impact(E.table_events(spark, d), root)


@query("pii_flow", with_entities("col_events", f"""
    select distinct source_table_full_name, source_column_name, target_table_full_name, target_column_name
    from col_events where source_column_name in ('email', 'phone', 'street_address') and {_RECENT}"""))
def _(spark, d):
    return lineage.pii_flow(E.column_events(spark, d, WINDOW), E.PII_COLUMNS, AS_OF)


_REACH = """
    reach as (select distinct source_table_full_name || '.' || source_column_name as node, 0 as depth from col_edges
        where source_column_name in ('email', 'phone', 'street_address') and starts_with(source_table_full_name, 'part:')
      union select dst, depth + 1 from reach join col_arcs on src = node)"""


def _reached(spark, d):
    return lineage.pii_flow_closure(E.column_events(spark, d), E.PII_COLUMNS, "part:")


@query("pii_flow_closure", with_entities("col_arcs", "select node, min(depth) as depth from reach group by node",
                                         extra=_REACH))
def _(spark, d):
    return _reached(spark, d)


@query("pii_leaks", with_entities("col_arcs", """
    select node, min(depth) as depth from reach where starts_with(node, 'customer:')
      and split_part(node, '.', 2) not in ('email', 'phone') group by node""", extra=_REACH))
def _(spark, d):
    return lineage.pii_leaks(_reached(spark, d), "customer:", ["email", "phone"])


@query("tag_propagation", with_entities("tags col_arcs", "select node, min(depth) as depth from tagged group by node",
                                        extra="""
    tagged as (select 'part:' || object || '.' || column_name as node, 0 as depth from tags
        where tag_name = 'pii' and tag_value = 'true'
      union select dst, depth + 1 from tagged join col_arcs on src = node)"""))
def _(spark, d):
    pii = _tags(spark, d).filter("tag_name = 'pii' and tag_value = 'true'").select(
        F.concat(F.lit("part:"), F.col("object"), F.lit("."), F.col("column_name")).alias("node"))
    return tags.propagate_tags(pii, lineage.column_arcs(E.column_events(spark, d)))


@query("lineage_with_external", with_entities("edges", """
    select source_table_full_name, target_table_full_name, min(origin) as origin from (
      select source_table_full_name, target_table_full_name, 'automatic' as origin from edges
      union all select 'customer:' || c_custkey, 'dashboard:' || c_mktsegment, 'external' from customer
      union all select 'order:' || o_orderkey, 'customer:' || o_custkey, 'external' from orders
        where o_orderstatus = 'F') group by all"""))
def _(spark, d):
    automatic = E.table_events(spark, d).select("source_table_full_name", "target_table_full_name")
    reports = load(spark, d, "customer").select(
        F.concat(F.lit("customer:"), "c_custkey").alias("source_table_full_name"),
        F.concat(F.lit("dashboard:"), "c_mktsegment").alias("target_table_full_name"))
    known = load(spark, d, "orders").filter("o_orderstatus = 'F'").select(
        F.concat(F.lit("order:"), "o_orderkey").alias("source_table_full_name"),
        F.concat(F.lit("customer:"), "o_custkey").alias("target_table_full_name"))
    return lineage.merge_edges(automatic, reports.unionByName(known))


@query("lineage_steps", """
    select distinct source_table_full_name, 'order:' || l_orderkey as target_table_full_name, entity_type from (
      select l_orderkey, 'part:' || l_partkey as source_table_full_name, 'TABLE' as entity_type from lineitem
      union all select l_orderkey, 'supplier:' || l_suppkey, 'TABLE' from lineitem
      union all select l_orderkey, 'function:' || l_returnflag, 'FUNCTION' from lineitem)""")
def _(spark, d):
    steps = load(spark, d, "lineitem").select(
        F.concat(F.lit("order:"), "l_orderkey").alias("target"),
        F.array(F.concat(F.lit("part:"), "l_partkey"), F.concat(F.lit("supplier:"), "l_suppkey")).alias("sources"),
        F.array(F.concat(F.lit("function:"), "l_returnflag")).alias("functions"))
    return lineage.edges_from_steps(steps)


@query("column_steps", """
    with ran as (select distinct l_orderkey, l_partkey, l_suppkey, l_returnflag from lineitem),
    edges as (
      select unnest([
        {'t': 'part:' || l_partkey, 's': 'p_retailprice', 'c': 'price'},
        {'t': 'supplier:' || l_suppkey, 's': 's_name', 'c': 'seller'}]) as e, l_orderkey from ran
      union all select unnest([
        {'t': 'part:' || l_partkey, 's': 'p_name', 'c': 'label'},
        {'t': 'part:' || l_partkey, 's': 'p_brand', 'c': 'label'},
        {'t': 'supplier:' || l_suppkey, 's': 's_acctbal', 'c': 'price'}]), l_orderkey from ran where l_returnflag = 'R'
      union all select unnest([
        {'t': 'part:' || l_partkey, 's': 'p_name', 'c': 'p_name'},
        {'t': 'part:' || l_partkey, 's': 'p_brand', 'c': 'p_brand'},
        {'t': 'part:' || l_partkey, 's': 'p_retailprice', 'c': 'p_retailprice'}]), l_orderkey from ran where l_returnflag = 'A')
    select distinct e.t as source_table_full_name, e.s as source_column_name,
      'order:' || l_orderkey as target_table_full_name, e.c as target_column_name from edges""")
def _(spark, d):
    sources = {"p": ["p_name", "p_brand", "p_retailprice"], "s": ["s_name", "s_acctbal"]}
    specs = [
        lineage.StepSpec("N", sources, {"price": "round(p_retailprice, 2)", "seller": "s.s_name"}),
        lineage.StepSpec("R", sources, {
            "price": "case when S_ACCTBAL < 0 then 0 else p.p_retailprice end", "seller": "s_name",
            "label": "concat_ws(' ', transform(array(p_name, p_brand), x -> upper(x)))"}),
        lineage.StepSpec("A", sources, {"p.*": "p.*", "price": "p_retailprice", "seller": "s_name"}),
    ]
    ran = load(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("kind"), F.concat(F.lit("order:"), "l_orderkey").alias("target"),
        F.array(F.struct(F.lit("p").alias("alias"), F.concat(F.lit("part:"), "l_partkey").alias("table")),
                F.struct(F.lit("s").alias("alias"), F.concat(F.lit("supplier:"), "l_suppkey").alias("table"))).alias("sources"))
    return lineage.column_edges_from_steps(ran, specs)


@query("subject_map", with_entities("clean_c clean_t clean_i", """
    select * from (
      select customer_id as subject_id, 'cleaned_customers' as table_name, count(*) as n_rows from clean_c group by all
      union all select customer_id, 'cleaned_transactions', count(*) from clean_t group by all
      union all select customer_id, 'cleaned_interactions', count(*) from clean_i group by all)
    where subject_id in (select c_custkey from customer where c_acctbal < 0)"""))
def _(spark, d):
    ids = load(spark, d, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("subject_id"))
    return lineage.subject_map({
        "cleaned_customers": (silver_c(spark, d), "customer_id"),
        "cleaned_transactions": (silver_t(spark, d, category=False), "customer_id"),
        "cleaned_interactions": (silver_i(spark, d), "customer_id"),
    }, ids)


# Streaming


def _stream_args(spark, d, table, label):
    base = shared_path(spark, label)
    # The braces make the path a pattern, which a stream needs for a table of a single file.
    return spark, f"{d}/{{{table}}}.parquet", load(spark, d, table).schema, f"{base}/out", f"{base}/checkpoint"


@query("stream_profile", """
    select cast(date_trunc('day', ts) as timestamp) as window_start, event_type, count(*) as n_rows,
      count(*) filter (value is null) as nulls, cast(sum(cast(value as decimal(18,4))) as double) as total
    from events group by all""")
def _(spark, d):
    spark, path, schema, out, checkpoint = _stream_args(spark, d, "events", "stream-profile")
    return jobs.stream_profile(spark, path, schema, "ts", "event_type", "value", out, checkpoint, scale=MONEY_SCALE)


@query("stream_quarantine", f"""
    select * from (select l_orderkey, l_linenumber, l_partkey, l_suppkey, {_FAILED_SQL} as reasons from lineitem)
    where reasons <> ''""")
def _(spark, d):
    spark, path, schema, out, checkpoint = _stream_args(spark, d, "lineitem", "stream-quarantine")
    _, bad = jobs.stream_quarantine(spark, path, schema, _line_rules(), out, checkpoint)
    return bad.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                      F.concat_ws(",", "failed").alias("reasons"))


@query("stream_pii_scan", f"select * from ({' union all '.join(
    f"select doc_id, '{label}' as label, cast(len(regexp_extract_all(text, '{p}')) as bigint) as matches from documents"
    for label, p in classify.PLAIN_PATTERNS.items())}) where matches > 0")
def _(spark, d):
    spark, path, schema, out, checkpoint = _stream_args(spark, d, "documents", "stream-pii")
    return jobs.stream_pii_scan(spark, path, schema, ["doc_id"], "text", out, checkpoint)
