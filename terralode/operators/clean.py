"""Schema-driven cleaning of whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from terralode.functions.cleaning import cast_dates, cast_numbers, clean_booleans, clean_strings, named
from terralode.session import local_rows

IMPUTED_TYPES = (T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
WIDER_IMPUTED_TYPES = IMPUTED_TYPES + (T.ByteType, T.DecimalType)
DATE_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)

# Bookkeeping columns that do not belong to a published table.
TECHNICAL_PREFIX = "_"
TECHNICAL_COLUMNS = ("created_at_raw", "updated_at_raw")


# Name of the column that carries the means past each row; dropped again at once.
MEANS = "__column_means"


def with_means(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, dict[str, Column]]:
    """The frame next to the mean of each named column, and how to refer to each mean.

    All means come out of one aggregate read as one scalar: however many columns
    are filled, the extra cost is one scan of those columns, and no row is joined.
    """
    if not names:
        return df, {}
    # Struct fields go by position: column names may hold any character.
    fields = {name: f"m{i}" for i, name in enumerate(names)}
    means = df.agg(F.struct(*[F.avg(named(n)).alias(f) for n, f in fields.items()]).alias("means"))
    carried = df.withColumn(MEANS, means.scalar())
    return carried, {name: F.col(MEANS).getField(field) for name, field in fields.items()}


def auto_clean(df: DataFrame, include_decimal: bool = False) -> DataFrame:
    """Clean every column by its type.

    Texts are trimmed, lowered and nulled when empty; numbers are cast safely and
    a missing one takes the column mean (so integers widen to double); dates and
    booleans are cast safely; every other type passes through.
    """
    imputed = WIDER_IMPUTED_TYPES if include_decimal else IMPUTED_TYPES
    carried, means = with_means(df, [f.name for f in df.schema if isinstance(f.dataType, imputed)])

    def cleaned(field: T.StructField) -> Column:
        col, kind = named(field.name), field.dataType
        if isinstance(kind, T.StringType):
            return clean_strings(col)
        if field.name in means:
            return F.coalesce(cast_numbers(col, kind.simpleString()), means[field.name])
        if isinstance(kind, DATE_TYPES):
            return cast_dates(col, kind.simpleString())
        if isinstance(kind, T.BooleanType):
            return clean_booleans(col)
        return col

    return carried.select([cleaned(f).alias(f.name) for f in df.schema])


def impute_numeric_mean(df: DataFrame) -> DataFrame:
    """Replace missing numbers by the column mean; leave all else alone."""
    carried, means = with_means(df, [f.name for f in df.schema if isinstance(f.dataType, IMPUTED_TYPES)])
    filled = [F.coalesce(named(n), means[n]) if n in means else named(n) for n in df.columns]
    return carried.select([col.alias(n) for col, n in zip(filled, df.columns)])


def is_technical(name: str) -> bool:
    return name.startswith(TECHNICAL_PREFIX) or name in TECHNICAL_COLUMNS


def drop_technical_columns(df: DataFrame) -> DataFrame:
    return df.select([named(n) for n in df.columns if not is_technical(n)])


def describe_columns(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type."""
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    return local_rows(df.sparkSession, rows, "position int, column_name string, data_type string")


def deduplicate(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column] | None = None,
    keep_rn: bool = True,
) -> DataFrame:
    """One row per key, null being a key like any other.

    ``order_by`` ranks the copies; left out, all sortable columns do, so that the
    survivor does not depend on the partitioning. The rank filter is pushed below
    the shuffle, so a task sends one row per key however many copies it holds.
    """
    if order_by is None:
        unsortable = (T.MapType, T.VariantType)
        order_by = [named(f.name) for f in df.schema if not isinstance(f.dataType, unsortable)]
    ranked = Window.partitionBy(*[named(k) for k in keys]).orderBy(*order_by)
    first = df.withColumn("rn", F.row_number().over(ranked)).filter(F.col("rn") == 1)
    return first if keep_rn else first.drop("rn")


def is_nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StructType, T.ArrayType, T.MapType))


def stringify_objects(df: DataFrame, legacy_null_tokens: bool = False) -> DataFrame:
    """Nested values become JSON text and untyped columns text.

    With ``legacy_null_tokens`` a missing text is written as the word ``None``.
    """

    def written(field: T.StructField) -> Column:
        col, kind = named(field.name), field.dataType
        if is_nested(kind) or isinstance(kind, T.VariantType):
            col, kind = F.to_json(col), T.StringType()
        elif isinstance(kind, T.NullType):
            col, kind = col.cast("string"), T.StringType()
        if legacy_null_tokens and isinstance(kind, T.StringType):
            col = F.coalesce(col, F.lit("None"))
        return col.alias(field.name)

    return df.select([written(f) for f in df.schema])


def attach_constants(df: DataFrame, values: dict[str, object], prefix: str = "meta_") -> DataFrame:
    """The same texts on every row, one column per entry."""
    return df.withColumns({prefix + name: F.lit(str(value)) for name, value in values.items()})
