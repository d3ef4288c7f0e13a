"""Tables, scripts and models in the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terralode.operators.clean import describe_columns
from terralode.operators.monitor import column_catalog, model_counts
from terralode.plans.load import created_tables, load_parquets
from terralode.plans.medallion import build_models
from terralode.queries.cleaning import BRONZE_LINEITEM_SQL, IMPUTED_LINEITEM, bronze_lineitem, rounded
from terralode.queries.registry import query, table
from terralode.session import shared_dir
from terralode.sinks.parquet import write_table
from terralode.sinks.tables import (
    append_by_name,
    create_schema,
    load_manifest,
    manifest,
    quoted,
    save_manifest,
    save_table,
    schema_for,
    split_to_tables,
)
from terralode.sources.listing import described_tables, probe_tables
from terralode.sources.scripts import export_all_tables, run_sql_script


def fresh_schema(spark: SparkSession, purpose: str) -> tuple[str, str]:
    """A schema of its own under the shared folder."""
    location = shared_dir(spark, purpose)
    return create_schema(spark, location.rsplit("/", 1)[-1].replace("-", "_"), location), location


@query("split_to_tables", "select 'part_' || event_type as table_name, count(*) as row_count, count(distinct user_id) as users from events group by 1")
def split_to_tables_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, location = fresh_schema(spark, "split")
    names = split_to_tables(table(spark, sf_dir, "events"), "event_type", schema, f"{location}/data", "part_")
    counts = None
    for name in names.values():
        one = spark.table(quoted(schema, name)).agg(
            F.count(F.lit(1)).alias("row_count"), F.count_distinct("user_id").alias("users")
        )
        one = one.select(F.lit(name).alias("table_name"), "row_count", "users")
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query(
    "load_tables",
    """
select 'ORDERS' as "table", count(*) as row_count from orders
union all select 'CUSTOMER', count(*) from customer union all select 'EVENTS', count(*) from events
""",
)
def load_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, location = fresh_schema(spark, "load")
    for name in ("orders", "customer", "events"):
        write_table(table(spark, sf_dir, name), f"{location}/files/{name}.parquet")
    loaded = created_tables(load_parquets(spark, f"{location}/files", schema))
    rows = None
    for row in loaded.collect():
        one = spark.table(quoted(schema, row["table"])).agg(F.count(F.lit(1)).alias("row_count"))
        one = one.select(F.lit(row["table"].upper()).alias("table"), "row_count")
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query(
    "load_tables_in_place",
    """
select 'customer' as table_name, count(*) as row_count, true as in_place from customer
union all select 'events', count(*), true from events union all select 'orders', count(*), true from orders
""",
)
def load_tables_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables declared over written files, counted by their footers."""
    schema, location = fresh_schema(spark, "place")
    for name in ("orders", "customer", "events"):
        write_table(table(spark, sf_dir, name), f"{location}/files/{name}.parquet")
    load_parquets(spark, f"{location}/files", schema, in_place=True)
    at = described_tables(spark, schema).select("table_name", F.col("place").endswith(F.concat(F.lit("/files/"), "table_name", F.lit(".parquet"))).alias("in_place"))
    return probe_tables(spark, schema).join(at, "table_name").select(F.lower("table_name").alias("table_name"), "row_count", "in_place")


@query("append_by_name", "select c_custkey, c_name, c_acctbal from customer union all select s_suppkey, s_name, s_acctbal from supplier")
def append_by_name_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, _ = fresh_schema(spark, "append")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    name = save_table(customers, schema, "parties")
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("c_acctbal"), F.col("s_name").alias("c_name"), F.col("s_suppkey").alias("c_custkey")
    )
    append_by_name(suppliers, schema, name)
    return spark.table(quoted(schema, name))


@query(
    "silver_model",
    f"""
with r as ({BRONZE_LINEITEM_SQL})
select {', '.join(f"round(coalesce(try_cast({c} as {t}), (select avg({c}) from r)), 4) as {c}" for c, t in IMPUTED_LINEITEM.items())},
       nullif(lower(trim(l_returnflag)), '') as l_returnflag, nullif(lower(trim(l_linestatus)), '') as l_linestatus,
       l_shipdate, l_shipday, is_open
from r
""",
)
def silver_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, location = fresh_schema(spark, "medal")
    save_table(bronze_lineitem(spark, sf_dir), schema, "line-item")
    save_manifest(manifest(spark, ["line_item"]), f"{location}/manifest")
    build_models(spark, load_manifest(spark, f"{location}/manifest"), schema, schema, schema)
    return rounded(spark.table(quoted(schema, "silver_line_item")))


@query("bronze_model", "select * from orders")
def bronze_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, _ = fresh_schema(spark, "bronze")
    save_table(table(spark, sf_dir, "orders"), schema, "orders")
    build_models(spark, manifest(spark, ["orders"]), schema, schema, schema)
    return spark.table(quoted(schema, "bronze_orders"))


@query("silver_with_transform", "select o_custkey, count(*) as orders, max(o_totalprice) as dearest from orders group by 1")
def silver_with_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A silver layer made by a transform of one's own in place of the cleaning, in a schema of its own."""
    schema, location = fresh_schema(spark, "custom")
    silver = create_schema(spark, schema_for(f" {schema}_marts ", schema), f"{location}_marts")
    save_table(table(spark, sf_dir, "orders"), schema, "orders")
    by_customer = lambda df: df.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("dearest"))
    build_models(spark, manifest(spark, ["orders"]), schema, schema_for(None, schema), silver, transform=by_customer)
    return spark.table(quoted(silver, "silver_orders"))


@query("model_counts", "select layer, 2 as models from (select 'bronze' as layer union all select 'silver')")
def model_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, _ = fresh_schema(spark, "models")
    for name in ("customer", "orders"):
        save_table(table(spark, sf_dir, name), schema, name)
    results = build_models(spark, manifest(spark, ["customer", "orders"]), schema, schema, schema)
    return model_counts(results.filter("ok")).withColumn("models", F.col("models").cast("int"))


@query(
    "sql_script",
    """
select o_custkey as customer, count(*) as orders, round(sum(o_totalprice), 2) as total from orders group by 1
""",
)
def sql_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, _ = fresh_schema(spark, "script")
    script = f"""
    -- orders per customer; the name below holds a semicolon
    CREATE TABLE totals (customer INTEGER PRIMARY KEY, orders INTEGER NOT NULL, total REAL, note TEXT);
    INSERT INTO totals
      SELECT o_custkey, count(*), sum(o_totalprice), 'a;b' FROM parquet.`{sf_dir}/orders.parquet` GROUP BY o_custkey;
    """
    run_sql_script(spark, script, schema)
    tables = export_all_tables(spark, schema)
    return tables["totals"].select("customer", "orders", F.round("total", 2).alias("total"))


@query("probe_tables", "select 'customer' as table_name, count(*) as row_count, true as has_bytes from customer union all select 'orders', count(*), true from orders")
def probe_tables_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, _ = fresh_schema(spark, "probe")
    for name in ("customer", "orders"):
        save_table(table(spark, sf_dir, name), schema, name)
    return probe_tables(spark, schema).select("table_name", "row_count", (F.col("bytes") > 0).alias("has_bytes"))


@query(
    "column_catalog",
    """
select 'orders' as table_name, string_agg(column_name, ',') as columns, (select count(*) from orders) as row_count from (describe orders)
union all select 'events', string_agg(column_name, ','), (select count(*) from events) from (describe events)
""",
)
def column_catalog_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = counts = None
    for name in ("orders", "events"):
        loaded = table(spark, sf_dir, name)
        one = describe_columns(loaded).withColumn("table_name", F.lit(name))
        count = loaded.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        described = one if described is None else described.unionByName(one)
        counts = count if counts is None else counts.unionByName(count)
    templates = column_catalog(described).join(counts, "table_name")
    return templates.select("table_name", F.array_join("template.column_name", ",").alias("columns"), "row_count")
