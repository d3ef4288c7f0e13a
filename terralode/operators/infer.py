"""Types of columns that were read as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from terralode.functions.cleaning import NA_TOKENS, na_to_null, named

# How integers, decimals and booleans are spelt in a text file.
INTEGER_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
DECIMAL_PATTERN = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"
BOOLEAN_TEXTS = ["True", "TRUE", "true", "False", "FALSE", "false"]
TRUE_TEXTS = ["True", "TRUE", "true"]


# Type of a column of booleans with gaps: a text column with two spellings.
BOOLEAN_TEXT = "boolean text"

# Kinds of value, as column_profile counts them.
BIGINT, LONG_DIGITS, DOUBLE, BOOLEAN, TEXT = range(1, 6)


def value_kind(col: Column) -> Column:
    """What a text reads as; null for a missing one."""
    # Blanks, signs, dots and digits all sort before the colon: other texts skip the patterns.
    number_like = col < ":"
    infinity_like = col.startswith("i") | col.startswith("I")
    # 18 digits always fit, so only longer ones are tried.
    fits = (F.length(col) <= 18) | F.trim(col).try_cast("bigint").isNotNull()
    return (
        F.when(number_like & col.rlike(INTEGER_PATTERN), F.when(fits, BIGINT).otherwise(LONG_DIGITS))
        .when((number_like | infinity_like) & col.rlike(DECIMAL_PATTERN), DOUBLE)
        .when(col.isin(BOOLEAN_TEXTS), BOOLEAN)
        .when(col.isNotNull(), TEXT)
    )


def kind_counts() -> list[Column]:
    """Aggregates over a kind column ``k``: how many values there are and how many read as each type."""
    k = F.col("k")
    return [
        F.count(k).alias("n_values"),
        F.count_if(k == BIGINT).alias("n_bigint"),
        F.count_if(k <= LONG_DIGITS).alias("n_digits"),
        F.count_if(k <= DOUBLE).alias("n_double"),
        F.count_if(k == BOOLEAN).alias("n_boolean"),
    ]


def name_at(names: Sequence[str], i: str) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), F.col(i)).alias("column_name")


def column_profile(df: DataFrame, names: Sequence[str] | None = None, na_tokens: list[str] = ()) -> DataFrame:
    """One row per text column: how many values there are and how many read as each type.

    A row's values are taken one under the other, so the plan has one set of
    expressions however many columns there are. The counts are combined before
    their shuffle, to a row per column and task.
    """
    names = list(df.columns if names is None else names)
    values = df.select(F.posexplode(F.array(*[named(name) for name in names])).alias("i", "v"))
    present = na_to_null(F.col("v"), list(na_tokens)) if na_tokens else F.col("v")
    kinds = values.select("i", present.alias("v")).select("i", value_kind(F.col("v")).alias("k"), F.lit(1).alias("n"))
    # A table without rows has its columns too.
    none = df.sparkSession.range(len(names)).select(F.col("id").cast("int").alias("i"), F.lit(None).cast("int").alias("k"), F.lit(0).alias("n"))
    counts = kinds.unionByName(none).groupBy("i").agg(F.sum("n").alias("n_rows"), *kind_counts())
    return counts.select(name_at(names, "i"), *[c for c in counts.columns if c != "i"])


def inferred_type() -> Column:
    """The type a profile row stands for.

    Whole numbers are bigint unless a value is missing, which makes them double.
    Booleans with a gap are the texts ``True`` and ``False``. A column without any
    value is double. An integer too long for bigint keeps the column as text, and
    so does a date.
    """
    n = F.col("n_values")
    return (
        F.when(F.col("n_rows") == 0, "string")
        .when(n == 0, "double")
        .when((F.col("n_bigint") == n) & (n == F.col("n_rows")), "bigint")
        .when((F.col("n_digits") == n) & (F.col("n_bigint") < n), "string")
        .when(F.col("n_double") == n, "double")
        .when(F.col("n_boolean") == n, F.when(n == F.col("n_rows"), "boolean").otherwise(BOOLEAN_TEXT))
        .otherwise("string")
    )


def infer_types(df: DataFrame, names: Sequence[str] | None = None, na_tokens: list[str] = ()) -> DataFrame:
    """Profile of each column with the type it should take."""
    return column_profile(df, names, na_tokens).withColumn("data_type", inferred_type())


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast text columns to the types found for them."""

    def typed(name: str) -> Column:
        col, kind = named(name), types.get(name, "string")
        if kind == "bigint":
            col = F.trim(col).cast("bigint")
        elif kind == "double":
            col = F.trim(col).cast("double")
        elif kind == "boolean":
            col = F.when(col.isNotNull(), col.isin(TRUE_TEXTS))
        elif kind == BOOLEAN_TEXT:
            col = F.when(col.isin(TRUE_TEXTS), "True").when(col.isNotNull(), "False")
        return col.alias(name)

    return df.select([typed(n) for n in df.columns])


def null_tokens_to_null(df: DataFrame, tokens: list[str], names: Sequence[str] | None = None) -> DataFrame:
    """Missing-value texts of the named columns to null."""
    names = set(df.columns if names is None else names)
    if not tokens:
        return df
    quoted = ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in tokens)

    def kept(name: str) -> str:
        # As text: a table may have a thousand columns, and each token is a call otherwise.
        col = "`" + name.replace("`", "``") + "`"
        return f"CASE WHEN NOT ({col} IN ({quoted})) THEN {col} END AS {col}" if name in names else col

    return df.selectExpr(*map(kept, df.columns))


def type_columns(df: DataFrame, na_tokens: list[str] = NA_TOKENS, names: Sequence[str] | None = None) -> DataFrame:
    """Missing-value texts to null, then text columns (all, or the named) to the type their values have.

    The types are settled by one pass over the data before this returns; only
    one small row per column reaches the driver.
    """
    texts = [f.name for f in df.schema if f.dataType.simpleString() == "string" and (names is None or f.name in names)]
    nulled = null_tokens_to_null(df, na_tokens, texts)
    if not texts:
        return nulled
    found = {r["column_name"]: r["data_type"] for r in infer_types(df, texts, na_tokens).collect()}
    return apply_types(nulled, found)
