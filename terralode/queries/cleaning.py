"""Cleaning queries. Nulls and bad values are put in first: the given tables hold none."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terralode.functions.cleaning import (
    cast_dates,
    cast_numbers,
    clean_booleans,
    clean_strings,
    normalize_nulls,
)
from terralode.operators.clean import (
    auto_clean,
    deduplicate,
    describe_columns,
    drop_technical_columns,
    impute_numeric_mean,
    stringify_objects,
)
from terralode.operators.infer import infer_types
from terralode.queries.registry import query, table


def bronze_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with gaps, padded texts, a date and a flag."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        F.when(F.col("l_linestatus") != "O", F.col("l_linenumber")).alias("l_linenumber"),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).alias("l_extendedprice"),
        "l_discount",
        "l_tax",
        F.concat(F.lit("  "), F.col("l_returnflag"), F.lit(" ")).alias("l_returnflag"),
        F.when(F.col("l_linestatus") == "O", F.lit("   ")).otherwise(F.col("l_linestatus")).alias("l_linestatus"),
        "l_shipdate",
        F.col("l_shipdate").cast("date").alias("l_shipday"),
        (F.col("l_linestatus") == "O").alias("is_open"),
    )


BRONZE_LINEITEM_SQL = """
  select l_orderkey, l_partkey, l_suppkey,
         case when l_linestatus <> 'O' then l_linenumber end as l_linenumber,
         case when l_linenumber <> 7 then l_quantity end as l_quantity,
         case when l_returnflag <> 'R' then l_extendedprice end as l_extendedprice,
         l_discount, l_tax,
         '  ' || l_returnflag || ' ' as l_returnflag,
         case when l_linestatus = 'O' then '   ' else l_linestatus end as l_linestatus,
         l_shipdate, cast(l_shipdate as date) as l_shipday, l_linestatus = 'O' as is_open
  from lineitem
"""

IMPUTED_LINEITEM = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "integer",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
}


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """Doubles rounded, so that the order of a sum does not show."""
    return df.select(
        [(F.round(f.name, places) if f.dataType.simpleString() == "double" else F.col(f.name)).alias(f.name) for f in df.schema]
    )


@query(
    "auto_clean",
    f"""
with r as ({BRONZE_LINEITEM_SQL})
select {', '.join(f"round(coalesce(try_cast({c} as {t}), (select avg({c}) from r)), 4) as {c}" for c, t in IMPUTED_LINEITEM.items())},
       nullif(lower(trim(l_returnflag)), '') as l_returnflag,
       nullif(lower(trim(l_linestatus)), '') as l_linestatus,
       try_cast(l_shipdate as timestamp) as l_shipdate,
       try_cast(l_shipday as date) as l_shipday,
       try_cast(is_open as boolean) as is_open
from r
""",
)
def auto_clean_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(auto_clean(bronze_lineitem(spark, sf_dir)))


@query(
    "auto_clean_strings",
    """
select c_custkey,
       nullif(lower(trim('  ' || upper(c_name) || ' ')), '') as c_name,
       nullif(lower(trim(case when c_mktsegment = 'BUILDING' then '  ' else c_mktsegment end)), '') as c_mktsegment
from customer
""",
)
def auto_clean_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("  "), F.upper("c_name"), F.lit(" "))
    segment = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("  ")).otherwise(F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", clean_strings(padded).alias("c_name"), clean_strings(segment).alias("c_mktsegment")
    )


@query(
    "impute_mean",
    """
with r as (
  select o_orderkey,
         case when o_orderstatus <> 'P' then o_custkey end as o_custkey,
         o_orderstatus,
         case when o_orderpriority <> '5-LOW' then o_totalprice end as o_totalprice
  from orders
)
select round(coalesce(o_orderkey, (select avg(o_orderkey) from r)), 4) as o_orderkey,
       round(coalesce(o_custkey, (select avg(o_custkey) from r)), 4) as o_custkey,
       o_orderstatus,
       round(coalesce(o_totalprice, (select avg(o_totalprice) from r)), 4) as o_totalprice
from r
""",
)
def impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("o_totalprice"),
    )
    return rounded(impute_numeric_mean(gaps))


@query(
    "cast_numbers",
    """
select p_partkey,
       try_cast(split_part(p_brand, '#', 2) as bigint) as brand_number,
       try_cast(p_name as bigint) as name_number,
       try_cast(cast(p_size as varchar) as smallint) as size_number,
       try_cast(case when p_type = 'ECONOMY' then 'n/a' else cast(p_retailprice as varchar) end as double) as price_number
from part
""",
)
def cast_numbers_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.when(F.col("p_type") == "ECONOMY", "n/a").otherwise(F.col("p_retailprice").cast("string"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        cast_numbers(F.split_part("p_brand", F.lit("#"), F.lit(2)), "bigint").alias("brand_number"),
        cast_numbers(F.col("p_name"), "bigint").alias("name_number"),
        cast_numbers(F.col("p_size").cast("string"), "smallint").alias("size_number"),
        cast_numbers(price, "double").alias("price_number"),
    )


@query(
    "cast_dates",
    """
with r as (
  select o_orderkey,
         case when o_orderpriority = '5-LOW' then 'n/a'
              when o_orderpriority = '1-URGENT' then '1997-13-45'
              else strftime(o_orderdate, '%Y-%m-%d') end as day_text,
         case when o_orderpriority = '2-HIGH' then 'soon'
              else strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') end as time_text
  from orders
)
select o_orderkey, try_cast(day_text as date) as order_day, try_cast(time_text as timestamp) as order_time from r
""",
)
def cast_dates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    day = (
        F.when(priority == "5-LOW", "n/a")
        .when(priority == "1-URGENT", "1997-13-45")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    time = F.when(priority == "2-HIGH", "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        cast_dates(day).alias("order_day"),
        cast_dates(time, "timestamp_ntz").alias("order_time"),
    )


@query(
    "clean_booleans",
    """
with r as (
  select doc_id, case when toxic = 1 then 'on' when quality = 1 then 'yes' else 'false' end as flag_text from labels
)
select doc_id, try_cast(flag_text as boolean) as flag from r
""",
)
def clean_booleans_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("toxic") == 1, "on").when(F.col("quality") == 1, "yes").otherwise("false")
    return table(spark, sf_dir, "labels").select("doc_id", clean_booleans(text).alias("flag"))


@query(
    "normalize_nulls",
    """
select event_id,
       nullif(case when event_type = 'view' then 'null' when event_type = 'click' then 'NULL' else event_type end, 'null') as event_type
from events
""",
)
def normalize_nulls_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    text = F.when(kind == "view", "null").when(kind == "click", "NULL").otherwise(kind)
    return table(spark, sf_dir, "events").select("event_id", normalize_nulls(text).alias("event_type"))


@query(
    "drop_technical",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders",
)
def drop_technical(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = table(spark, sf_dir, "orders").withColumns(
        {
            "_loaded": F.current_timestamp(),
            "created_at_raw": F.col("o_orderdate").cast("string"),
            "updated_at_raw": F.col("o_orderdate").cast("string"),
        }
    )
    return drop_technical_columns(marked)


PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


@query(
    "describe_columns",
    "select d.column_name, n.n_values from (describe part) d join ("
    + " union all ".join(f"select '{c}' as column_name, count({c}) as n_values from part" for c in PART_COLUMNS)
    + ") n using (column_name)",
)
def describe_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    counts = F.array(*[F.struct(F.lit(c).alias("column_name"), F.count(c).alias("n_values")) for c in part.columns])
    filled = part.agg(counts.alias("c")).select(F.inline("c"))
    return describe_columns(part).join(filled, "column_name").select("column_name", "n_values")


@query(
    "dedup_by_key",
    """
select doc_id, text, lang, source, n_chars, rn
from (select *, row_number() over (partition by text order by text, doc_id) as rn from documents)
where rn = 1
""",
)
def dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = deduplicate(table(spark, sf_dir, "documents"), ["text"], [F.col("doc_id")])
    return first.withColumn("rn", F.col("rn").cast("bigint"))


@query(
    "dedup_latest",
    """
select event_id, ts, user_id, event_type, value
from (select *, row_number() over (partition by user_id order by ts desc, event_id) as rn from events)
where rn = 1
""",
)
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return deduplicate(events, ["user_id"], [F.col("ts").desc(), F.col("event_id")], keep_rn=False)


TEXT_ORDERS = {
    "o_orderkey": "cast(o_orderkey as varchar)",
    "o_custkey": "case when o_orderstatus <> 'P' then cast(o_custkey as varchar) end",
    "o_orderstatus": "o_orderstatus",
    "o_totalprice": "cast(o_totalprice as varchar)",
    "o_orderday": "strftime(o_orderdate, '%Y-%m-%d')",
    "o_urgent": "case when o_orderpriority = '1-URGENT' then 'True' else 'False' end",
    "o_nothing": "cast(null as varchar)",
}


@query(
    "infer_types",
    "with t as (select "
    + ", ".join(f"{e} as {n}" for n, e in TEXT_ORDERS.items())
    + " from orders), p as ("
    + " union all ".join(
        f"""
select '{n}' as column_name, count(*) as n_rows, count({n}) as n_values,
       count(*) filter (where regexp_full_match({n}, '\\s*[+-]?[0-9]+\\s*') and try_cast({n} as bigint) is not null) as n_bigint,
       count(*) filter (where try_cast({n} as double) is not null) as n_double,
       count(*) filter (where {n} in ('True','TRUE','true','False','FALSE','false')) as n_boolean
from t"""
        for n in TEXT_ORDERS
    )
    + """)
select column_name, n_rows, n_values, n_bigint, n_double, n_boolean,
       case when n_values = 0 then 'double'
            when n_bigint = n_values and n_values = n_rows then 'bigint'
            when n_double = n_values then 'double'
            when n_boolean = n_values then case when n_values = n_rows then 'boolean' else 'boolean text' end
            else 'string' end as data_type
from p
""",
)
def infer_types_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderday"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "True").otherwise("False").alias("o_urgent"),
        F.lit(None).cast("string").alias("o_nothing"),
    )
    return infer_types(texts).drop("n_digits")


@query(
    "stringify_objects",
    """
select event_id,
       cast(to_json([event_type, cast(user_id as varchar)]) as varchar) as tags,
       cast(to_json({'event_type': event_type, 'user_id': user_id}) as varchar) as who
from events
""",
)
def stringify_objects_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "events").select(
        "event_id",
        F.array("event_type", F.col("user_id").cast("string")).alias("tags"),
        F.struct("event_type", "user_id").alias("who"),
    )
    return stringify_objects(nested)
