"""SQL scripts and catalog exports."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from terralode.sources.listing import list_tables

# Column types of a script and the types they stand for.
TYPE_SYNONYMS = {"TEXT": "STRING", "REAL": "DOUBLE", "INTEGER": "BIGINT", "INT": "BIGINT"}
# What a table of files does not keep of a column or table definition.
CONSTRAINTS = [
    r",\s*(CONSTRAINT\s+\S+\s+)?(PRIMARY\s+KEY|FOREIGN\s+KEY|UNIQUE|CHECK)\s*\([^()]*\)(\s*REFERENCES\s+[^\s(]+\s*\([^()]*\))?",
    r"\bREFERENCES\s+[^\s(]+\s*\([^()]*\)",
    r"\bPRIMARY\s+KEY\b",
    r"\bAUTOINCREMENT\b",
    r"\bUNIQUE\b",
    r"\bNOT\s+NULL\b",
]
# Statements about the session that wrote the script, of no use here.
SKIPPED = re.compile(r"(?i)(pragma|begin|commit|end|set|lock|unlock|create\s+(unique\s+)?index)\b")

# A statement: quoted texts, comments and everything else up to a semicolon.
_STATEMENT = re.compile(r"""(?:'(?:[^']|'')*'|"(?:[^"]|"")*"|--[^\n]*|/\*.*?\*/|[^;'"-]|-)+""", re.S)
_COMMENT = re.compile(r"""('(?:[^']|'')*'|"(?:[^"]|"")*")|--[^\n]*|/\*.*?\*/""", re.S)


def statements(script: str) -> list[str]:
    """Statements of a script, comments removed, semicolons inside quotes kept."""
    bare = _COMMENT.sub(lambda m: m.group(1) or " ", script)
    found = [s.strip() for s in _STATEMENT.findall(bare)]
    return [s for s in found if s and not SKIPPED.match(s)]


def spark_statement(statement: str) -> str:
    """A statement with the script's column types and constraints put in Spark's terms."""
    if not re.match(r"(?i)create\s+table", statement):
        return statement
    for constraint in CONSTRAINTS:
        statement = re.sub("(?i)" + constraint, "", statement)
    for name, spark_type in TYPE_SYNONYMS.items():
        statement = re.sub(rf"(?i)\b{name}\b(?=\s*(,|\)|DEFAULT\b))", spark_type, statement)
    return statement if re.search(r"(?i)\busing\b", statement) else statement + " USING parquet"


def run_sql_script(spark: SparkSession, script: str, schema: str) -> list[str]:
    """Run a script's statements in a schema of its own; returns the tables it holds then.

    A session of its own keeps the current schema and the way names are quoted
    from whatever else runs; the catalog is shared.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.ansi.enabled", "true")
    session.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    session.catalog.setCurrentDatabase(schema)
    for statement in statements(script):
        session.sql(spark_statement(statement))
    return user_tables(spark, schema)


def user_tables(spark: SparkSession, schema: str) -> list[str]:
    """Tables of a schema but those whose name is reserved (``sqlite`` and one more character)."""
    names = list_tables(spark, schema).filter(~F.col("tableName").like("sqlite_%"))
    return [r["tableName"] for r in names.orderBy("tableName").collect()]


def export_all_tables(spark: SparkSession, schema: str) -> dict[str, DataFrame]:
    """Every user table of a schema by name."""
    return {name: spark.table(f"`{schema}`.`{name}`") for name in user_tables(spark, schema)}


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    **properties: str,
) -> DataFrame:
    """A table of an external database, read over several connections when a column to split by is given.

    Filters, limits and column choices made on the result reach the database.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()
