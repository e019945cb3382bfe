"""Expectations on tables, as rows ``(check, passed, detail)``.

Checks on data become one aggregate over one scan; checks on schemas read the plan only and run no job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from inplay.functions import count_where
from inplay.schema import DATE_COLUMN, EXTRACT_REQUIRED, KEY_COLUMN, LABEL_COLUMN, NON_FEATURES


class ExpectationError(ValueError):
    """A strict validation found at least one failed check."""


@dataclass(frozen=True)
class Expectation:
    """A check: ``violations`` counts what breaks it, and zero violations pass."""

    name: str
    violations: Column


def not_empty() -> Expectation:
    return Expectation("not_empty", F.when(F.count("*") == 0, 1).otherwise(0))


def not_null(*columns: str) -> list[Expectation]:
    return [Expectation(f"{c}_not_null", count_where(F.col(c).isNull())) for c in columns]


def no_nulls(columns: Sequence[str]) -> Expectation:
    any_null = F.lit(False)
    for c in columns:
        any_null = any_null | F.col(c).isNull()
    return Expectation("no_nulls", count_where(any_null))


def binary(column: str) -> Expectation:
    """Values other than 0/1; nulls are left to ``not_null``."""
    return Expectation(f"{column}_binary", count_where(~F.col(column).cast("double").isin(0.0, 1.0)))


def unique(column: str) -> Expectation:
    return Expectation(f"{column}_unique", F.count(column) - F.count_distinct(column))


def validate(df: DataFrame, expectations: Iterable[Expectation], strict: bool = False) -> DataFrame:
    """Evaluate all expectations in one aggregate. With ``strict`` a failure raises."""
    items = list(expectations)
    counted = df.agg(*[e.violations.cast("bigint").alias(f"v{i}") for i, e in enumerate(items)])
    entries = F.array(*[F.struct(F.lit(e.name).alias("check"), F.col(f"v{i}").alias("violations"))
                        for i, e in enumerate(items)])
    report = (counted.select(F.explode(entries).alias("e"))
                     .select("e.check", (F.col("e.violations") == 0).alias("passed"),
                             F.concat_ws(" ", F.col("e.violations").cast("string"), F.lit("violations")).alias("detail")))
    if strict:
        failed = report.where("not passed").collect()  # one row per expectation at most
        if failed:
            raise ExpectationError("; ".join(f"{r['check']}: {r['detail']}" for r in failed))
    return report


def extract_expectations(label: str = LABEL_COLUMN) -> list[Expectation]:
    return [not_empty(), *not_null(label), binary(label)]


def table_expectations() -> list[Expectation]:
    return [*not_null(DATE_COLUMN, LABEL_COLUMN, "bb_type", KEY_COLUMN), unique(KEY_COLUMN)]


def require_rows(df: DataFrame, name: str) -> None:
    """Raise when there is no first row; reads no further than that row."""
    if df.isEmpty():
        raise ExpectationError(f"{name} is empty")


def require_columns(columns: Iterable[str], required: Iterable[str] = EXTRACT_REQUIRED) -> None:
    missing = sorted(set(required) - set(columns))
    if missing:
        raise ExpectationError(f"missing required columns: {missing}")


def require_binary_type(df: DataFrame, column: str) -> None:
    """A label is boolean or numeric; text cannot be 0/1."""
    kind = df.schema[column].dataType
    if not isinstance(kind, (T.BooleanType, T.NumericType)):
        raise ExpectationError(f"{column} is {kind.simpleString()}, not a 0/1 label")


def require_feature_schema(
    train: DataFrame, test: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
    forbidden: Sequence[str] = NON_FEATURES,
) -> None:
    """Features hold no label or key, have their declared kind, and are the same on both sides."""
    features = [*numeric, *categorical]
    leaking = [c for c in features if c in forbidden]
    if leaking:
        raise ExpectationError(f"not allowed as features: {leaking}")
    for name, df in (("train", train), ("test", test)):
        missing = [c for c in features if c not in df.columns]
        if missing:
            raise ExpectationError(f"{name} lacks features: {missing}")
        kinds = {f.name: f.dataType for f in df.schema.fields}
        wrong = [c for c in numeric if not isinstance(kinds[c], T.NumericType)]
        if wrong:
            raise ExpectationError(f"{name} has non-numeric values in {wrong}")
        wrong = [c for c in categorical if isinstance(kinds[c], T.NumericType)]
        if wrong:
            raise ExpectationError(f"{name} has numeric values in categorical {wrong}")
    differing = [c for c in features if train.schema[c].dataType != test.schema[c].dataType]
    if differing:
        raise ExpectationError(f"train and test types differ in {differing}")


def require_references(categorical: Sequence[str], references: Mapping[str, str]) -> None:
    missing = [c for c in categorical if c not in references]
    if missing:
        raise ExpectationError(f"no reference level for {missing}")


def same_rows(left: DataFrame, right: DataFrame, key: str = KEY_COLUMN) -> DataFrame:
    """Whether two frames hold the same keys the same number of times, from one grouped count."""
    sides = (left.select(key, F.lit(1).alias("n")).unionByName(right.select(key, F.lit(-1).alias("n")))
                 .groupBy(key).agg(F.sum("n").alias("n")))
    return validate(sides, [Expectation("same_rows", count_where(F.col("n") != 0))])


# ---- schema expectations as rows

SCHEMA_TABLE = T.StructType([
    T.StructField("position", T.IntegerType(), False), T.StructField("column", T.StringType(), False),
    T.StructField("type", T.StringType(), False), T.StructField("kind", T.StringType(), False)])


def _kind(data_type: T.DataType) -> str:
    return "numeric" if isinstance(data_type, T.NumericType) else simple if (simple := data_type.simpleString()) in ("boolean", "string", "date") else "other"


def _literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A small frame of literals, which the JVM makes itself."""
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    entries = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)]) for row in rows]
    return spark.range(1).select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def schema_table(df: DataFrame) -> DataFrame:
    """(position, column, type, kind) of a frame's columns; no job runs on its rows."""
    rows = [(i, f.name, f.dataType.simpleString(), _kind(f.dataType)) for i, f in enumerate(df.schema.fields)]
    return _literal_rows(df.sparkSession, rows, SCHEMA_TABLE)


def names_table(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """(position, column) of a list of names."""
    return _literal_rows(spark, list(enumerate(names)), T.StructType(SCHEMA_TABLE.fields[:2]))


def _failing(name: str, broken: DataFrame) -> DataFrame:
    """One row of a check: it passes if ``broken`` (column) has no rows, and else lists them in order."""
    listed = broken.agg(F.array_join(F.sort_array(F.collect_list("column")), ", ").alias("detail"))
    return listed.select(F.lit(name).alias("check"), (F.col("detail") == "").alias("passed"), "detail")


def same_order(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Exact names in exact order: positions that one side lacks or names otherwise."""
    a, e = actual.select("position", F.col("column").alias("found")), expected.select("position", F.col("column").alias("wanted"))
    broken = a.join(e, "position", "full").where(~F.col("found").eqNullSafe(F.col("wanted")))
    return _failing("column_order", broken.select(F.coalesce("wanted", "found").alias("column")))


def has_columns(actual: DataFrame, required: DataFrame) -> DataFrame:
    """Required names that the frame lacks: an anti join."""
    return _failing("required_columns", required.join(actual, "column", "left_anti"))


def without_columns(features: DataFrame, forbidden: DataFrame) -> DataFrame:
    """Features that must not be such: a semi join."""
    return _failing("no_leakage", features.join(forbidden, "column", "left_semi"))


def same_columns(left: DataFrame, right: DataFrame) -> DataFrame:
    """Names or types that only one of two frames has."""
    both = lambda x, y: x.join(y, ["column", "type"], "left_anti").select("column")
    return _failing("same_features", both(left, right).union(both(right, left)).distinct())


def has_kind(actual: DataFrame, wanted: DataFrame, kind: str, holds: bool = True) -> DataFrame:
    """Of the ``wanted`` names those whose kind is another (or, with ``holds`` false, is this one)."""
    wrong = (F.col("kind") != kind) if holds else (F.col("kind") == kind)
    return _failing(f"{'' if holds else 'not_'}{kind}", actual.where(wrong).join(wanted.select("column"), "column", "left_semi"))


def has_reference(categorical: DataFrame, references: DataFrame) -> DataFrame:
    """Categorical names without a reference level."""
    return _failing("reference_levels", categorical.join(references, "column", "left_anti"))


def ordered_windows(spark: SparkSession, window: Sequence[date]) -> DataFrame:
    """Training ends on or after its begin, and the test begins after that."""
    days = _literal_rows(spark, [tuple(window)], T.StructType([T.StructField(n, T.DateType()) for n in ("train_start", "train_end", "test_start")]))
    wrong = F.array_compact(F.array(F.when(F.col("train_end") < F.col("train_start"), "train_end"), F.when(F.col("test_start") <= F.col("train_end"), "test_start")))
    return _failing("window_order", days.select(F.explode(wrong).alias("column")))


def rows_match(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """As many labels as feature rows: rows without a label are listed by their number."""
    counted = df.select(*features, label).agg(F.count("*").alias("rows"), F.count(label).alias("labels"))
    broken = counted.where("rows <> labels").select(F.concat(F.lit(label), F.lit(" "), (F.col("rows") - F.col("labels")).cast("string")).alias("column"))
    return _failing("label_rows", broken)


def schema_report(
    train: DataFrame, test: DataFrame, columns: Sequence[str], numeric: Sequence[str], categorical: Sequence[str],
    references: Iterable[str], window: Sequence[date], label: str = LABEL_COLUMN, required: Iterable[str] = EXTRACT_REQUIRED,
    forbidden: Iterable[str] = NON_FEATURES, strict: bool = False,
) -> DataFrame:
    """All expectations on the schemas of two splits as rows ``(check, passed, detail)``; ``detail`` names what breaks one.

    With ``strict`` a failure raises.
    """
    spark = train.sparkSession
    features = names_table(spark, [*numeric, *categorical])
    left, right = schema_table(train), schema_table(test)
    kept = lambda side: side.join(features.select("column"), "column", "left_semi")
    report = reduce(DataFrame.unionByName, [
        same_order(left, names_table(spark, columns)), has_columns(left, names_table(spark, sorted(required))),
        without_columns(features, names_table(spark, sorted(forbidden))), same_columns(kept(left), kept(right)),
        has_kind(left, names_table(spark, numeric), "numeric"), has_kind(left, names_table(spark, categorical), "numeric", holds=False).withColumn("check", F.lit("categorical")),
        has_reference(names_table(spark, categorical), names_table(spark, sorted(references))), ordered_windows(spark, window),
        rows_match(train, [c for c in dict.fromkeys((*numeric, *categorical)) if c in train.columns and c != label], label)])
    if strict:
        failed = report.where("not passed").collect()  # one row for each check at most
        if failed:
            raise ExpectationError("; ".join(f"{r['check']}: {r['detail']}" for r in failed))
    return report
