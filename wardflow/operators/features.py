"""Feature engineering: diagnosis groups and categories, comorbidity count,
per-day ratios, medication-change score and class weights.

All row-level features are one projection of built-in expressions (whole-stage
codegen, no Python). Class weights need the class balance: an Estimator fits
it with one aggregate, and the model applies it as two literals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.diagnosis import diag_category, diag_group
from wardflow.functions.indicators import count_groups_present, count_values_in, ratio
from wardflow.schema import (CHANGE_VALUES, DIAG_CATEGORY_OTHER, DIAGNOSIS_COLUMNS, LABEL,
                             MAJOR_DISEASE_GROUPS, MEDICATION_COLUMNS, PER_DAY_RATIOS, STAY_COLUMN,
                             WEIGHT, q)
from wardflow.operators.profile import class_counts


def diagnosis_groups(df: DataFrame, cols: Sequence[str] = tuple(DIAGNOSIS_COLUMNS),
                     drop_source: bool = True) -> DataFrame:
    """Add ``<col>_group`` for each diagnosis column; drop the sources."""
    cols = [c for c in cols if c in df.columns]
    keep = [F.col(q(c)) for c in df.columns if not (drop_source and c in cols)]
    return df.select(*keep, *[diag_group(F.col(q(c))).alias(f"{c}_group") for c in cols])


def diagnosis_category(df: DataFrame, col: str = "diag_1", out: str | None = None,
                       semantics: str = "lexical", fill: str = DIAG_CATEGORY_OTHER) -> DataFrame:
    """Add the ICD-9 chapter of ``col`` (``<col>_category``); NULL -> ``fill``."""
    out = out or f"{col}_category"
    return df.withColumn(out, diag_category(F.col(q(col)), other=fill, semantics=semantics))


def comorbidity_count(df: DataFrame, group_cols: Sequence[str] = tuple(f"{c}_group" for c in DIAGNOSIS_COLUMNS),
                      groups: Sequence[str] = tuple(MAJOR_DISEASE_GROUPS), out: str = "comorbidity_count") -> DataFrame:
    return df.withColumn(out, count_groups_present([F.col(q(c)) for c in group_cols], groups))


def per_day_ratios(df: DataFrame, pairs=tuple(PER_DAY_RATIOS), stay: str = STAY_COLUMN,
                   default: float | None = None) -> DataFrame:
    """``numerator / stay`` as double per pair; a zero stay gives NULL (or ``default``)."""
    return df.withColumns({out: ratio(F.col(q(num)), F.col(q(stay)), default) for out, num in pairs})


def change_score(df: DataFrame, cols: Sequence[str] = tuple(MEDICATION_COLUMNS),
                 values: Sequence[str] = tuple(CHANGE_VALUES), out: str = "med_change_score") -> DataFrame:
    return df.withColumn(out, count_values_in([F.col(q(c)) for c in cols], values))


def engineer_rows(df: DataFrame, ratio_default: float | None = None) -> DataFrame:
    """The stateless part of feature engineering, as one projection."""
    out = diagnosis_groups(df)
    out = comorbidity_count(out)
    out = per_day_ratios(out, default=ratio_default)
    return change_score(out)


# ---------------------------------------------------------------------------
# Class weights
# ---------------------------------------------------------------------------

class _WeightParams(Params):
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label column", typeConverter=TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "output weight column", typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(labelCol=LABEL, weightCol=WEIGHT)


class ClassWeigher(Estimator, _WeightParams, DefaultParamsReadable, DefaultParamsWritable):
    """weight(0) = P / (P + N), weight(1) = N / (P + N), fitted with one aggregate."""

    def __init__(self, labelCol: str = LABEL, weightCol: str = WEIGHT):
        super().__init__()
        self._set(labelCol=labelCol, weightCol=weightCol)

    def _fit(self, dataset: DataFrame) -> "ClassWeigherModel":
        label = self.getOrDefault(self.labelCol)
        if label not in dataset.columns:
            return self.model()
        row = class_counts(dataset, label).first()
        return self.model(int(row["n_positive"]), int(row["n_negative"]))

    def model(self, pos: int | None = None, neg: int | None = None) -> "ClassWeigherModel":
        """The fitted model, given the class counts; without them (no label) it adds no weight."""
        model = ClassWeigherModel()
        model._set(labelCol=self.getOrDefault(self.labelCol), weightCol=self.getOrDefault(self.weightCol))
        if pos is None:
            return model
        if pos + neg == 0:
            raise ValueError("class weights need at least one labelled row")
        model._set(negativeWeight=pos / (pos + neg), positiveWeight=neg / (pos + neg))
        return model


class ClassWeigherModel(Model, _WeightParams, DefaultParamsReadable, DefaultParamsWritable):
    negativeWeight = Param(Params._dummy(), "negativeWeight", "weight of label 0", typeConverter=TypeConverters.toFloat)
    positiveWeight = Param(Params._dummy(), "positiveWeight", "weight of other labels", typeConverter=TypeConverters.toFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        label = self.getOrDefault(self.labelCol)
        if label not in dataset.columns or not self.isDefined(self.negativeWeight):
            return dataset
        w0, w1 = self.getOrDefault(self.negativeWeight), self.getOrDefault(self.positiveWeight)
        w = F.when(F.col(q(label)) == 0.0, F.lit(w0)).otherwise(F.lit(w1))
        return dataset.withColumn(self.getOrDefault(self.weightCol), w.cast("double"))


def class_weights(df: DataFrame, label: str = LABEL, out: str = WEIGHT) -> DataFrame:
    """Fit the class balance of ``df`` and add the weight column to it."""
    return ClassWeigher(labelCol=label, weightCol=out).fit(df).transform(df)


def engineer(df: DataFrame, weights: bool = True) -> DataFrame:
    """Diagnosis groups, comorbidity count, ratios, change score, then class weights."""
    out = engineer_rows(df)
    return class_weights(out) if weights and LABEL in out.columns else out
