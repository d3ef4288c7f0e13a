"""Monitoring queries. Events stand for runs, tasks and objects of a store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terralode.functions.measures import bytes_human, timestamp_text
from terralode.operators import monitor
from terralode.operators.catalog import classify_fetches, fetch_report, match_resources
from terralode.queries.registry import query, table

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def history(events: DataFrame, *ids: Column) -> DataFrame:
    """Events with a state and times: some never started, some not ended."""
    value = F.col("value")
    end = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), value.cast("decimal(18,6)"))
    return events.select(
        F.col("event_type").alias("dag_id"),
        *ids,
        F.when(value >= 50, "running").when(value < 5, "failed").otherwise("success").alias("state"),
        F.when(value < 200, F.col("ts")).alias("start_date"),
        F.when(value < 50, end).alias("end_date"),
        F.col("ts").alias("execution_date"),
    )


def runs_of(events: DataFrame) -> DataFrame:
    """A run per event."""
    return history(events, F.concat(F.lit("run_"), F.col("event_id")).alias("run_id"))


RUNS_SQL = """
  select event_type as dag_id, 'run_' || event_id as run_id,
         case when value >= 50 then 'running' when value < 5 then 'failed' else 'success' end as state,
         case when value < 200 then ts end as start_date,
         case when value < 50 then ts + to_microseconds(cast(round(value * 1000000) as bigint)) end as end_date,
         ts as execution_date
  from events
"""

DURATION_SQL = "epoch_us(end_date - start_date) / 1000000.0"


TASKS_SQL = RUNS_SQL.replace("'run_' || event_id as run_id", "'user_' || user_id as run_id, 'task_' || event_id as task_id")


def user_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A task per event, a run per user and workflow."""
    return history(
        table(spark, sf_dir, "events"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("run_id"),
        F.concat(F.lit("task_"), F.col("event_id")).alias("task_id"),
    )


def listing_of(events: DataFrame) -> DataFrame:
    """Events as objects of a store."""
    folder = F.when(F.col("event_type") == "view", "").otherwise(F.concat(F.col("event_type"), F.lit("/")))
    suffix = F.when(F.col("event_type") == "error", ".PARQUET").otherwise(".parquet")
    return events.select(
        F.concat(F.lit("parquets_files/"), folder, F.col("event_id"), suffix).alias("key"),
        F.round(F.col("value") * 102400).cast("bigint").alias("size_bytes"),
        F.col("ts").alias("last_modified"),
    )


LISTING_SQL = """
  select 'parquets_files/' || case when event_type = 'view' then '' else event_type || '/' end || event_id
           || case when event_type = 'error' then '.PARQUET' else '.parquet' end as key,
         cast(round(value * 102400) as bigint) as size_bytes, ts as last_modified
  from events
"""


def human_sql(n: str) -> str:
    cases = " ".join(
        f"when cast({n} as double) < {1024 ** (i + 1)}.0 then printf('%.2f', cast({n} as double) / {1024**i}.0) || ' {u}'"
        for i, u in enumerate(["B", "KB", "MB", "GB", "TB"])
    )
    return f"case {cases} else printf('%.2f', cast({n} as double) / {1024**5}.0) || ' PB' end"


@query(
    "recent_runs",
    f"""
select dag_id, run_id, state, start_date, end_date, execution_date, {DURATION_SQL} as duration_s
from ({RUNS_SQL}) order by start_date desc nulls last, run_id limit 50
""",
)
def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.recent_runs(runs_of(table(spark, sf_dir, "events")), limit=50)


@query(
    "recent_runs_filtered",
    f"""
select dag_id, run_id, state, start_date, end_date, {DURATION_SQL} as duration_s
from (select * from ({RUNS_SQL}) order by start_date desc nulls last, run_id limit 300)
where dag_id in ('click', 'error')
""",
)
def recent_runs_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = monitor.recent_runs(runs_of(table(spark, sf_dir, "events")), limit=300, only=["click", "error"])
    return picked.drop("execution_date")


@query(
    "task_durations",
    f"""
select task_id, state, start_date, end_date, {DURATION_SQL} as duration_s
from ({TASKS_SQL}) where dag_id = 'purchase' and run_id = 'user_7' order by start_date asc nulls last
""",
)
def task_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.task_durations(user_tasks(spark, sf_dir), "purchase", "user_7")


@query(
    "run_durations",
    f"""
select run_id, state, start_date, end_date, {DURATION_SQL} as duration_s
from ({RUNS_SQL}) where dag_id = 'click' order by start_date desc nulls last, run_id limit 50
""",
)
def run_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.run_durations(runs_of(table(spark, sf_dir, "events")), "click", limit=50)


@query(
    "run_total_and_slowest",
    f"""
with t as (select task_id, {DURATION_SQL} as duration_s from ({TASKS_SQL}))
select round((select sum(duration_s) from t), 4) as total_s, duration_s as slowest_s, task_id as slowest_task
from t order by duration_s desc nulls last, task_id desc limit 1
""",
)
def run_total_and_slowest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = monitor.total_and_slowest(monitor.with_duration(user_tasks(spark, sf_dir)))
    return out.withColumn("total_s", F.round("total_s", 4))


@query(
    "state_counts",
    f"""
select count(*) filter (where state = 'success') as success,
       count(*) filter (where state = 'failed') as failed,
       count(*) filter (where state = 'running') as running
from ({RUNS_SQL})
""",
)
def state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.state_counts(runs_of(table(spark, sf_dir, "events")))


LAST_STATE_SQL = f"""
  select dag_id, coalesce(state, '—') as state, coalesce(run_id, '—') as run_id
  from (select *, row_number() over (partition by dag_id order by start_date desc nulls last, run_id desc) as rn from ({RUNS_SQL}))
  where rn = 1
"""


@query("last_state", LAST_STATE_SQL)
def last_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.last_state(runs_of(table(spark, sf_dir, "events")))


@query(
    "health",
    f"""
with s as ({LAST_STATE_SQL}),
     m as (select max(case when dag_id = 'click' then state end) as ingestion,
                  max(case when dag_id = 'view' then state end) as conversion,
                  max(case when dag_id = 'signup' then state end) as load,
                  max(case when dag_id = 'error' then state end) as models from s),
     f as (select count(*) filter (where lower(key) like '%.pq') as files from ({LISTING_SQL})),
     a as (select list_filter([
             case when ingestion = 'success' and files = 0 then 'ingested_but_no_parquet' end,
             case when conversion = 'failed' then 'conversion_failed' end,
             case when load = 'failed' then 'load_failed' end,
             case when models = 'failed' then 'model_generation_failed' end], lambda x: x is not null) as found from m, f)
select case when len(found) = 0 then 'ok' else array_to_string(found, ',') end as alerts from a
""",
)
def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    files = monitor.count_with_suffix(listing_of(events), [".pq"])
    roles = {"ingestion": "click", "conversion": "view", "load": "signup", "models": "error"}
    alerts = monitor.health(monitor.last_state(runs_of(events)), files, roles)
    return alerts.select(F.array_join("alerts", ",").alias("alerts"))


@query(
    "volume_kpis",
    f"""
with k as (select count(*) as files, cast(coalesce(sum(size_bytes), 0) as bigint) as total_bytes,
                  max(last_modified) as last_modified from ({LISTING_SQL}))
select files, total_bytes, last_modified, {human_sql('total_bytes')} as total_size from k
""",
)
def volume_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.volume_kpis(listing_of(table(spark, sf_dir, "events")))


@query(
    "top_folder_breakdown",
    f"""
with r as (select case when starts_with(key, 'parquets_files/') then substr(key, 16) else key end as rest from ({LISTING_SQL}))
select case when contains(rest, '/') then split_part(rest, '/', 1) else 'root' end as "group", count(*) as files
from r group by 1
""",
)
def top_folder_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.top_folder_breakdown(listing_of(table(spark, sf_dir, "events")), "parquets_files/")


@query(
    "capped_listing",
    f"""
select key, size_bytes, last_modified, {human_sql('size_bytes')} as size
from (select * from ({LISTING_SQL}) order by key limit 5000)
""",
)
def capped_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.capped_listing(listing_of(table(spark, sf_dir, "events")), 5000)


@query(
    "latest_parquet",
    f"""
select key, {human_sql('size_bytes')} as size, last_modified
from (select * from ({LISTING_SQL}) where lower(key) like '%.parquet' order by last_modified desc, key limit 200)
""",
)
def latest_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.latest_with_suffix(listing_of(table(spark, sf_dir, "events")), [".parquet"], 200)


@query(
    "count_parquet",
    f"select count(*) filter (where lower(key) like '%.parquet') as files from ({LISTING_SQL})",
)
def count_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.count_with_suffix(listing_of(table(spark, sf_dir, "events")), [".parquet"])


@query(
    "bytes_human",
    "select doc_id, "
    + ", ".join(f"{human_sql(f'(n_chars * {1024**k})')} as size_{k}" for k in range(5))
    + f", {human_sql('(n_chars * n_chars * 7)')} as size_squared from documents",
)
def bytes_human_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_chars")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        *[bytes_human(n * F.lit(1024**k).cast("bigint")).alias(f"size_{k}") for k in range(5)],
        bytes_human(n * n * 7).alias("size_squared"),
    )


@query("distinct_sorted", "select distinct event_type as dag_id from events order by 1")
def distinct_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").select(F.col("event_type").alias("dag_id"))
    return monitor.distinct_sorted(runs, "dag_id")


@query(
    "catalog_probe",
    "select * from ("
    + " union all ".join(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in TABLES)
    + ") order by row_count desc, table_name limit 50",
)
def catalog_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = None
    for name in TABLES:
        one = table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("row_count"))
        one = one.select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts.orderBy(F.col("row_count").desc(), "table_name").limit(50)


@query(
    "fetch_report",
    """
select case when contains(url, 'spam-farm') then 'skipped' when contains(url, '#') then 'error' else 'ok' end as outcome,
       count(*) as files
from pages group by 1
""",
)
def fetch_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    fetched = table(spark, sf_dir, "pages").select(
        "url",
        F.when(url.contains("spam-farm"), 404).when(url.contains("#"), 500).otherwise(200).alias("status"),
        F.lit(None).cast("string").alias("error"),
    )
    return fetch_report(classify_fetches(fetched))


RESOURCE_FORMATS = {"click": "CSV", "view": "json", "error": "", "signup": "shp"}
RESOURCE_SUFFIXES = [(5, ".csv"), (20, ".GeoJSON?v=2"), (60, ".parquet#top"), (100, "")]


def resources_of(events: DataFrame) -> DataFrame:
    """Events as catalogued resources: a dataset per user, a declared format, a URL."""
    declared = F.lit("exe")
    for kind, fmt in RESOURCE_FORMATS.items():
        declared = F.when(F.col("event_type") == kind, fmt).otherwise(declared)
    suffix = F.lit(".exe")
    for bound, text in reversed(RESOURCE_SUFFIXES):
        suffix = F.when(F.col("value") < bound, text).otherwise(suffix)
    return events.select(
        F.concat(F.lit("dataset-"), F.col("user_id")).alias("slug"),
        "event_id",
        declared.alias("format"),
        F.concat(F.lit("https://data.example.org/d.v1/f"), F.col("event_id"), suffix).alias("url"),
    )


RESOURCES_SQL = f"""
  select 'dataset-' || user_id as slug, event_id,
         case {' '.join(f"when event_type = '{k}' then '{v}'" for k, v in RESOURCE_FORMATS.items())} else 'exe' end as format,
         'https://data.example.org/d.v1/f' || event_id ||
         case {' '.join(f"when value < {b} then '{s}'" for b, s in RESOURCE_SUFFIXES)} else '.exe' end as url
  from events
"""


@query(
    "ingestion_totals",
    f"""
with e as (select *, lower(format) as fmt,
                  lower(regexp_extract(regexp_replace(url, '[?#].*$', ''), '\\.([^./]*)$', 1)) as url_ext from ({RESOURCES_SQL})),
     m as (select slug, event_id, fmt as ext from e union select slug, event_id, url_ext from e),
     k as (select slug, count(*) as resources from m
           where ext in ('csv', 'json', 'shp', 'geojson', 'parquet') group by slug)
select count(*) as datasets, cast(coalesce(sum(resources), 0) as bigint) as files from k
""",
)
def ingestion_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = match_resources(resources_of(table(spark, sf_dir, "events")))
    per_dataset = matched.groupBy("slug").agg(F.count(F.lit(1)).alias("resources"))
    return monitor.ingestion_totals(per_dataset)


@query(
    "slowest_first",
    f"select task_id, state, {DURATION_SQL} as duration_s from ({TASKS_SQL}) order by 3 desc nulls last",
)
def slowest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.slowest_first(monitor.with_duration(user_tasks(spark, sf_dir)))


@query("timestamp_texts", "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as seen_at from events")
def timestamp_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", timestamp_text(F.col("ts")).alias("seen_at"))
