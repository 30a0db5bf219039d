"""Views that give the catalogue operators input from the benchmark tables. One SQL text serves both engines: tables stand in braces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents pages labels conversations".split()

VIEWS = {
    "offer": """
        select cast(l_partkey as varchar(20)) as product_key, concat('s', cast(l_suppkey % 8 as varchar(20))) as retailer, l_linenumber as pack_size,
          case when l_linestatus = 'F' and l_linenumber = 7 then null else floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 end as price_aud,
          case when l_returnflag = 'A' then floor(l_extendedprice / l_quantity * 90 + 0.5) / 100 end as member_price_aud,
          case when l_returnflag = 'R' then floor(l_extendedprice / l_quantity * 110 + 0.5) / 100 when l_returnflag = 'N' then floor(l_extendedprice / l_quantity * 95 + 0.5) / 100 end as was_price_aud,
          case when l_returnflag <> 'N' then 'special' end as promo,
          case when l_discount > 0.05 then 'In Stock' when l_discount > 0.02 then 'Sold out' end as availability,
          cast(l_shipdate as date) as day, l_orderkey as o1, l_linenumber as o2, l_suppkey as o3, l_extendedprice as o4, l_quantity as o5, l_discount as o6, l_tax as o7, l_shipdate as o8, l_returnflag as o9, l_linestatus as o10
        from {lineitem}""",
    "listing": """
        select p_partkey as ord, p_brand as brand,
          concat(p_name, ' ', case p_partkey % 6 when 0 then concat(cast(p_size * 25 as varchar(20)), 'ml') when 1 then concat('Case of ', cast(p_size as varchar(20))) when 2 then concat('6 Pack ', cast(1990 + p_size as varchar(20)))
            when 3 then concat(cast(p_size as varchar(20)), ' x 375ml') when 4 then concat('1.5 Litre ', cast(p_size % 20 as varchar(20)), '.5% abv') else 'RedWidget NV -' end,
            case p_type when 'ECONOMY' then ' sparkling ale' when 'SMALL' then ' Shiraz' when 'MEDIUM' then ' gin' when 'PROMO' then ' premix cola' when 'LARGE' then ' Tumbarumba' else '' end) as name_raw,
          case when p_partkey % 3 = 0 then null else lpad(cast(p_partkey % 1500 as varchar(20)), 13, '0') end as gtin,
          p_retailprice as price, concat('$', cast(cast(floor(p_retailprice) as bigint) as varchar(20)), '.50 each') as price_raw, p_size as size, p_type as kind
        from {part}""",
    "review": """
        select d.doc_id as ord, d.text, d.lang as source, case when d.doc_id % 3 = 0 then concat(case when d.doc_id % 2 = 0 then 'An' else 'AN' end, cast(d.doc_id % 4 as varchar(20))) end as author, l.quality * 5 as rating_raw, case when l.toxic = 1 then null else 5 end as rating_scale,
          case when d.doc_id % 7 = 0 then 'Highest' when d.doc_id % 7 = 1 then null else 'Newest' end as sort_order
        from {documents} d left join {labels} l on d.doc_id = l.doc_id""",
    "attempt": """
        select concat('t', cast(user_id as varchar(20))) as target, ts, event_id as seq, value,
          case event_type when 'view' then 'handout' when 'click' then 'partial' when 'purchase' then 'done' when 'error' then 'fail' else 'enqueue' end as kind, cast(floor(value) as bigint) as n
        from {events}""",
}


def sql_of(text: str) -> str:
    """For an engine where the tables are views of their own names."""
    for name in TABLES:
        text = text.replace("{" + name + "}", name)
    return text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name].replace("varchar(20)", "string")
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def with_views(sql: str) -> str:
    """The SQL with the views that it names in front: v_offer, v_listing, v_review, v_attempt."""
    import re

    named = [n for n in VIEWS if re.search(rf"\bv_{n}\b", sql)]
    heads = [f"v_{n} as ({sql_of(VIEWS[n])})" for n in named]
    body = sql.strip()
    if body.lower().startswith("with recursive "):
        return "with recursive " + ",\n".join([*heads, body[15:]])
    if body.lower().startswith("with "):
        return "with " + ",\n".join([*heads, body[5:]])
    return ("with " + ",\n".join(heads) + "\n" if heads else "") + body
