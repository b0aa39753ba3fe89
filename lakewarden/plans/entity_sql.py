"""The entities in SQL, as common table expressions for the comparison queries."""

from __future__ import annotations

from lakewarden.sources import entities as E
from lakewarden.sources import synth as S


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def sql_pick(index: str, values: list[str]) -> str:
    return f"{sql_list(values)}[cast(({index}) % {len(values)} + 1 as int)]"


_tag_name = sql_pick("cast(l_quantity as bigint)", list(E.TAG_VALUES))
_tag_value = "case " + " ".join(
    f"when {_tag_name} = '{n}' then {sql_pick('l_suppkey', v)}" for n, v in E.TAG_VALUES.items()) + " end"
_column = sql_pick("l_linenumber - 1", E.COLUMN_NAMES)
_renamed = f"case when l_linenumber % 2 = 0 then 'contact_' || {_column} else {_column} end"

# name -> (names it needs, body)
_CTES: dict[str, tuple[list[str], str]] = {
    "nations": ([], "select n_nationkey, n_name, r_name from nation join region on n_regionkey = r_regionkey"),
    "customers": (["nations"], """
        select c_custkey as customer_id, split_part(c_name, '#', 1) as first_name,
          split_part(c_name, '#', 2) as last_name,
          lower(replace(c_name, '#', '.')) || '@example.com' as email,
          '(' || cast(c_custkey % 800 + 200 as varchar) || ') '
            || lpad(cast(c_custkey * 7919 % 1000 as varchar), 3, '0') || '-'
            || lpad(cast(c_custkey * 104729 % 10000 as varchar), 4, '0') as phone,
          cast(c_custkey % 999 + 1 as varchar) || ' Market Street' as street_address,
          'City ' || cast(c_custkey % 97 as varchar) as city, 'State ' || cast(c_nationkey as varchar) as state,
          n_name as country, r_name as region,
          date '2022-01-01' + cast(c_custkey % 731 as int) as created_date,
          c_name as name, c_mktsegment as segment, c_acctbal as balance
        from customer join nations on c_nationkey = n_nationkey"""),
    "transactions": ([], f"""
        select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as transaction_id,
          o_custkey as customer_id, cast(l_extendedprice * (1 - l_discount) as decimal(18,4)) as amount,
          {sql_pick('l_suppkey', S.CURRENCIES)} as currency,
          case when l_returnflag = 'R' then 'refund' else 'purchase' end as transaction_type,
          p_type as product_category, cast(l_shipdate as date) as transaction_date
        from lineitem left join orders on l_orderkey = o_orderkey left join part on l_partkey = p_partkey"""),
    "interactions": ([], f"""
        select event_id as interaction_id, user_id as customer_id, event_type as channel,
          {sql_pick('event_id', S.INTERACTION_TYPES)} as interaction_type, value as sentiment_score,
          cast(ts as date) as interaction_date
        from events"""),
    "clean_c": (["customers"], """
        select customer_id, first_name, last_name, email, phone, street_address, city, state, country, region,
          created_date
        from customers where customer_id is not null and email is not null"""),
    "clean_t": (["transactions"], """
        select * from transactions
        where transaction_id is not null and customer_id is not null and amount is not null and amount >= 0"""),
    "clean_i": (["interactions"], """
        select * from interactions
        where interaction_id is not null and customer_id is not null and interaction_type is not null"""),
    "totals": (["clean_t"], """
        select customer_id, count(*) as total_transactions, cast(sum(amount) as double) as total_amount
        from clean_t group by customer_id"""),
    "i_totals": (["clean_i"], """
        select customer_id, count(*) as interaction_count,
          cast(sum(cast(sentiment_score as decimal(18,4))) as double) / count(sentiment_score) as avg_sentiment
        from clean_i group by customer_id"""),
    "health": (["clean_c", "totals", "i_totals"], """
        select c.customer_id, first_name, last_name, region, created_date,
          coalesce(total_transactions, 0) as transaction_count, coalesce(total_amount, 0.0) as total_amount,
          coalesce(interaction_count, 0) as interaction_count, coalesce(avg_sentiment, 0.0) as avg_sentiment,
          round(((cast(('0x' || substr(md5(cast(c.customer_id as varchar)), 1, 16)) as ubigint)::hugeint % 1000 * 616
            + cast(('0x' || substr(md5(cast(c.customer_id as varchar)), 17, 16)) as ubigint)::hugeint % 1000) % 1000)
            ::double / 10, 1) as health_score
        from clean_c c left join totals t on c.customer_id = t.customer_id
          left join i_totals i on c.customer_id = i.customer_id"""),
    "revenue": (["clean_c", "clean_t"], """
        select c.region, t.product_category, date_trunc('month', t.transaction_date)::timestamp as month,
          count(*) as transaction_count, cast(sum(amount) as double) as total_revenue,
          cast(sum(amount) as double) / count(amount) as avg_revenue
        from clean_t t join clean_c c on t.customer_id = c.customer_id
        where transaction_type = 'purchase' group by all"""),
    "revenue_all": (["clean_c", "clean_t"], """
        select c.region, t.product_category, date_trunc('month', t.transaction_date)::timestamp as month,
          count(*) as transaction_count, cast(sum(amount) as double) as total_revenue,
          cast(sum(amount) as double) / count(amount) as avg_transaction_value
        from clean_t t join clean_c c on t.customer_id = c.customer_id group by all"""),
    "assets": ([], f"""
        select p_type as catalog, p_brand as schema, p_partkey as object, p_name as name,
          {sql_pick('p_size', E.OBJECT_TYPES)} as object_type, p_type || ' ' || p_name || ' ' || p_brand as comment
        from part"""),
    "asset_columns": (["assets"], f"""
        select catalog, schema, object, unnest({sql_list(E.COLUMN_NAMES)}) as column_name from assets"""),
    "members": ([], """
        select 'seg:' || c_mktsegment as grp, c_name as principal from customer
        union all select 'nat:' || n_name, c_name from customer join nation on c_nationkey = n_nationkey"""),
    "memberships": (["members", "nations"], """
        select distinct principal, grp from members
        union select principal, 'reg:' || r_name from members join nations on grp = 'nat:' || n_name"""),
    "grant_log": (["assets", "nations"], """
        select securable_type, catalog, case when securable_type <> 'CATALOG' then schema end as schema,
          case when securable_type = 'TABLE' then object end as object, grantee, privilege, action, changed_on, seq
        from (
          select case o_orderpriority when '1-URGENT' then 'CATALOG'
              when '2-HIGH' then case when o_orderstatus = 'P' then 'CATALOG' else 'SCHEMA' end
              when '3-MEDIUM' then case when o_orderstatus = 'P' then 'CATALOG' else 'SCHEMA' end
              else 'TABLE' end as securable_type,
            a.catalog, a.schema, a.object,
            case o_orderkey % 50 when 0 then 'seg:' || c_mktsegment when 1 then 'nat:' || n_name
              when 2 then 'reg:' || r_name else c_name end as grantee,
            case o_orderpriority when '1-URGENT' then 'USE CATALOG' when '2-HIGH' then 'USE SCHEMA'
              else 'SELECT' end as privilege,
            case when o_orderstatus = 'F' then 'REVOKE' else 'GRANT' end as action,
            cast(o_orderdate as date) as changed_on, o_orderkey as seq
          from orders join customer on o_custkey = c_custkey join nations on c_nationkey = n_nationkey
            join assets a on a.object = o_orderkey % (select count(*) from part))"""),
    "object_owners": (["assets"], """
        select catalog, schema, object, c_name as owner from assets join customer on object = c_custkey"""),
    "owners": (["object_owners"], """
        select catalog, schema, object, owner from object_owners
        union all select catalog, schema, null, c_name
          from (select catalog, schema, min(object) as k from object_owners group by all) join customer on k = c_custkey
        union all select catalog, null, null, c_name
          from (select catalog, max(object) as k from object_owners group by all) join customer on k = c_custkey"""),
    "net": (["grant_log"], """
        select securable_type, catalog, schema, object, grantee, privilege from (
          select *, row_number() over (partition by securable_type, catalog, schema, object, grantee, privilege
            order by changed_on desc, seq desc, action desc) as rn from grant_log) where rn = 1 and action = 'GRANT'"""),
    "held": (["net", "owners"], """
        select securable_type, catalog, schema, object, grantee, privilege from net
        union all select case when schema is null then 'CATALOG' else 'SCHEMA' end, catalog, schema, object, owner,
          unnest(case when schema is null then ['USE CATALOG', 'USE SCHEMA', 'SELECT'] else ['USE SCHEMA', 'SELECT'] end)
          from owners where object is null"""),
    "who": (["memberships"], """
        select c_name as principal, c_name as grantee from customer
        union select principal, grp from memberships"""),
    "uc": (["held", "who"], """
        select distinct principal, catalog from held join who using (grantee) where privilege = 'USE CATALOG'"""),
    "us": (["held", "who", "assets"], """
        select principal, catalog, schema from held join who using (grantee)
        where privilege = 'USE SCHEMA' and securable_type = 'SCHEMA'
        union select principal, c.catalog, a.schema
        from (select distinct principal, catalog from held join who using (grantee)
          where privilege = 'USE SCHEMA' and securable_type = 'CATALOG') c
        join (select distinct catalog, schema from assets) a on a.catalog = c.catalog"""),
    "sel": (["held", "who", "assets", "owners"], """
        select principal, catalog, schema, object from held join who using (grantee)
        where privilege = 'SELECT' and securable_type = 'TABLE'
        union select principal, a.catalog, a.schema, a.object
        from (select distinct principal, catalog, schema from held join who using (grantee)
          where privilege = 'SELECT' and securable_type = 'SCHEMA') s
        join assets a on a.catalog = s.catalog and a.schema = s.schema
        union select principal, a.catalog, a.schema, a.object
        from (select distinct principal, catalog from held join who using (grantee)
          where privilege = 'SELECT' and securable_type = 'CATALOG') c
        join assets a on a.catalog = c.catalog
        union select owner, catalog, schema, object from owners where object is not null"""),
    "usage": ([], """
        select event_type as sku_name, case when event_type = 'purchase' then 'HOURS' else 'GB' end as usage_unit,
          value as usage_quantity, cast(ts as date) as usage_date, user_id as principal from events"""),
    "tag_log": (["assets"], f"""
        select a.catalog, a.schema, a.object, {_column} as column_name, {_tag_name} as tag_name,
          {_tag_value} as tag_value, case when l_returnflag = 'R' then 'UNSET' else 'SET' end as action,
          cast(l_shipdate as date) as changed_on, l_orderkey as seq
        from lineitem join assets a on l_partkey = a.object"""),
    "tags": (["tag_log"], """
        select catalog, schema, object, column_name, tag_name, tag_value from (
          select *, row_number() over (partition by catalog, schema, object, column_name, tag_name
            order by changed_on desc, seq desc, action desc, tag_value desc) as rn from tag_log)
        where rn = 1 and action = 'SET'"""),
    "edge_events": ([], """
          select 'supplier:' || l_suppkey as source_table_full_name, 'part:' || l_partkey as target_table_full_name,
            'TABLE' as entity_type, cast(l_shipdate as date) as event_date from lineitem
          union all select 'part:' || l_partkey, 'order:' || l_orderkey, 'VIEW', cast(l_shipdate as date) from lineitem
          union all select 'order:' || o_orderkey, 'customer:' || o_custkey, 'TABLE', cast(o_orderdate as date)
            from orders"""),
    "edges": (["edge_events"], """
        select source_table_full_name, target_table_full_name, entity_type, max(event_date) as event_date
        from edge_events group by all"""),
    "recent_edges": (["edge_events"], """
        select source_table_full_name, target_table_full_name, entity_type, max(event_date) as event_date
        from edge_events where event_date between date '2001-01-01' - 7 and date '2001-01-01' group by all"""),
    "col_events": ([], f"""
          select 'part:' || l_partkey as source_table_full_name, {_column} as source_column_name,
            'order:' || l_orderkey as target_table_full_name, {_renamed} as target_column_name,
            cast(l_shipdate as date) as event_date from lineitem
          union all select 'order:' || l_orderkey, {_renamed}, 'customer:' || o_custkey, {_renamed},
            cast(l_shipdate as date) from lineitem join orders on l_orderkey = o_orderkey
            where l_linestatus = 'O'"""),
    "col_edges": (["col_events"], """
        select source_table_full_name, source_column_name, target_table_full_name, target_column_name,
          max(event_date) as event_date from col_events group by all"""),
    "claims": (["assets", "nations"], """
        select distinct r_name as domain, catalog, schema, object from lineitem join supplier on l_suppkey = s_suppkey
          join nations on s_nationkey = n_nationkey join assets on l_partkey = object"""),
    "col_arcs": (["col_edges"], """
        select distinct source_table_full_name || '.' || source_column_name as src,
          target_table_full_name || '.' || target_column_name as dst from col_edges"""),
}

# Inlined, this one makes DuckDB 2.0 fail with an internal error.
_MATERIALIZED = {"grant_log"}


def with_entities(names: str, body: str, extra: str = "") -> str:
    """``body`` behind the named expressions and those they need; ``extra`` adds expressions of its own."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in _CTES[name][0]:
            need(other)
        if name not in order:
            order.append(name)

    for name in names.split():
        need(name)
    head = ", ".join(f"{n} as {'materialized ' if n in _MATERIALIZED else ''}({_CTES[n][1]})" for n in order)
    if extra:
        head = f"{head}, {extra}" if head else extra
    return f"with recursive {head} {body}"
