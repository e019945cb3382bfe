"""Imputation, scaling and encoding, learned from the training rows only."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from inplay.operators.checks import ExpectationError, require_references
from inplay.operators.quantiles import bracket_columns, finish_quantiles
from inplay.schema import REFERENCE_LEVELS


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> tuple[int, dict[str, dict]]:
    """Row count, and per column the median, and mean and population deviation after imputing it. NaN is missing."""
    if not columns:
        return df.count(), {}
    df = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    stats = [F.count("*").alias("rows")]
    for c in columns:
        stats += [F.avg(c).alias(f"mean__{c}"), F.var_pop(c).alias(f"var__{c}"), F.min(c).alias(f"low__{c}"), F.max(c).alias(f"high__{c}")]
    first = df.agg(*stats, *bracket_columns(columns)).first().asDict()
    medians = finish_quantiles(df, first, columns)
    rows, out = first["rows"], {}
    for c in columns:
        n, median = first[f"n__{c}"], medians[c]
        if not n:
            continue
        if first[f"low__{c}"] == first[f"high__{c}"]:
            # One value: sums would give it a scale that is nothing but rounding.
            out[c] = {"median": median, "mean": median, "scale": 1.0}
            continue
        # Mean and variance of the observed values joined with (rows - n) copies of the median.
        share = (rows - n) / rows
        gap = median - first[f"mean__{c}"]
        mean = first[f"mean__{c}"] + gap * share
        var = first[f"var__{c}"] * (1 - share) + gap * gap * share * (1 - share)
        out[c] = {"median": median, "mean": mean, "scale": var**0.5 or 1.0}
    return rows, out


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, level, n) of every non-null level of the given text columns."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns])
    return (df.select(F.explode(entries).alias("e")).where(F.col("e.level").isNotNull())
              .groupBy("e.column", "e.level").agg(F.count("*").alias("n")))


def modes(counts: DataFrame) -> DataFrame:
    """Most frequent level of each column of ``level_counts``; equal counts give the smallest level."""
    return counts.groupBy("column").agg(mode_of_counts())


def mode_of_counts() -> Column:
    return F.min_by("level", F.struct(-F.col("n"), F.col("level"))).alias("mode")


def learn_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, dict]:
    """Sorted levels and mode of each column: as many levels as the model gets columns."""
    if not columns:
        return {}
    counts = level_counts(df, columns)
    levels = counts.groupBy("column").agg(F.sort_array(F.collect_list("level")).alias("levels"), mode_of_counts())
    found = {r["column"]: {"levels": r["levels"], "mode": r["mode"]} for r in levels.collect()}
    return {c: found.get(c, {"levels": [], "mode": None}) for c in columns}


class _TableParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "numeric input columns", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "categorical input columns", TypeConverters.toListString)
    references = Param(Params._dummy(), "references", "level dropped from each categorical column", TypeConverters.identity)
    outputCol = Param(Params._dummy(), "outputCol", "feature vector column", TypeConverters.toString)


class TablePreprocessor(Estimator, _TableParams, DefaultParamsReadable, DefaultParamsWritable):
    """Median and mode imputation, standardisation and one-hot encoding against reference levels."""

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, references=None, outputCol=None):
        super().__init__()
        self._setDefault(numericCols=[], categoricalCols=[], references=dict(REFERENCE_LEVELS), outputCol="features")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "TablePreprocessorModel":
        numeric = self.getOrDefault("numericCols")
        categorical = self.getOrDefault("categoricalCols")
        references = self.getOrDefault("references")
        require_references(categorical, references)
        rows, summary = numeric_summary(dataset, numeric)
        if not rows:
            raise ExpectationError("no training rows")
        learned = learn_levels(dataset, categorical)
        for c in categorical:
            if references[c] not in learned[c]["levels"]:
                raise ExpectationError(f"reference level {references[c]!r} of {c} is not in the training rows")
        unseen = [c for c in numeric if c not in summary]
        if unseen:
            warnings.warn(f"no training values in {unseen}: left out of the features", stacklevel=2)
        return TablePreprocessorModel(
            numericCols=[c for c in numeric if c in summary], categoricalCols=categorical, references=references,
            outputCol=self.getOrDefault("outputCol"), summary=summary, learned=learned, rows=rows)


class TablePreprocessorModel(Model, _TableParams, DefaultParamsReadable, DefaultParamsWritable):
    """The learned values; transforming is a projection of native expressions."""

    summary = Param(Params._dummy(), "summary", "median, mean and scale per numeric column", TypeConverters.identity)
    learned = Param(Params._dummy(), "learned", "levels and mode per categorical column", TypeConverters.identity)
    rows = Param(Params._dummy(), "rows", "training rows", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, references=None, outputCol=None,
                 summary=None, learned=None, rows=None):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def n_rows(self) -> int:
        return self.getOrDefault("rows")

    def restricted(self, numeric: Sequence[str], categorical: Sequence[str]) -> "TablePreprocessorModel":
        """The same learned values for a subset of the columns, as if fitted on these alone."""
        return TablePreprocessorModel(
            numericCols=[c for c in numeric if c in self.getOrDefault("numericCols")],
            categoricalCols=[c for c in categorical if c in self.getOrDefault("categoricalCols")],
            references=self.getOrDefault("references"), outputCol=self.getOrDefault("outputCol"),
            summary=self.getOrDefault("summary"), learned=self.getOrDefault("learned"), rows=self.n_rows)

    def imputed(self, column: str) -> Column:
        if column in self.getOrDefault("numericCols"):
            value = F.col(column).cast("double")
            value = F.when(~F.isnan(value), value)
            return F.coalesce(value, F.lit(float(self.getOrDefault("summary")[column]["median"])))
        return F.coalesce(F.col(column).cast("string"), F.lit(self.getOrDefault("learned")[column]["mode"]))

    def scaled(self, column: str) -> Column:
        s = self.getOrDefault("summary")[column]
        return (self.imputed(column) - F.lit(float(s["mean"]))) / F.lit(float(s["scale"]))

    def encoded(self) -> dict[str, Column]:
        """Feature name to expression: the numeric block, then indicators of the non-reference levels."""
        out = {f"numeric__{c}": self.scaled(c) for c in self.getOrDefault("numericCols")}
        references: Mapping[str, str] = self.getOrDefault("references")
        for c in self.getOrDefault("categoricalCols"):
            for level in self.getOrDefault("learned")[c]["levels"]:
                if level != references[c]:
                    out[f"categorical__{c}_{level}"] = (self.imputed(c) == F.lit(level)).cast("double")
        return out

    @property
    def feature_names(self) -> list[str]:
        return list(self.encoded())

    def _transform(self, dataset: DataFrame) -> DataFrame:
        encoded = self.encoded()
        wide = dataset.select("*", *[e.alias(n) for n, e in encoded.items()])
        assembled = VectorAssembler(inputCols=list(encoded), outputCol=self.getOrDefault("outputCol")).transform(wide)
        return assembled.drop(*encoded)
