"""Missing-value imputation as a persistable MLlib Estimator / Model.

Fitting costs two aggregate jobs whatever the column count: one multi-column
mean, and one Expand + partial aggregate for all categorical modes. The fitted
model holds literals only, so ``transform`` never triggers a job and works on
streaming frames too.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.operators.profile import column_modes, numeric_means
from wardflow.schema import CATEGORICAL_COLUMNS, NUMERIC_COLUMNS, q


class _ImputerParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "columns filled with their mean",
                        typeConverter=TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "columns filled with their mode",
                            typeConverter=TypeConverters.toListString)
    maxCategories = Param(Params._dummy(), "maxCategories",
                          "fail the fit if a categorical column has more distinct values (0 = no limit)",
                          typeConverter=TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(numericCols=list(NUMERIC_COLUMNS), categoricalCols=list(CATEGORICAL_COLUMNS),
                         maxCategories=0)


class EncounterImputer(Estimator, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Mean fill for numeric columns, mode fill (NULLs ignored, ties -> smallest) for categoricals.

    A mean filled into an integer column is truncated, as a cast would do.
    A column with no non-NULL value gets no fill value and stays NULL.
    The mode job also counts distinct values per column; with ``maxCategories``
    the fit fails on a column above it, which bounds the label sets a later
    indexer brings to the driver at no extra pass.
    """

    def __init__(self, numericCols: Sequence[str] | None = None, categoricalCols: Sequence[str] | None = None,
                 maxCategories: int | None = None):
        super().__init__()
        if numericCols is not None:
            self._set(numericCols=list(numericCols))
        if categoricalCols is not None:
            self._set(categoricalCols=list(categoricalCols))
        if maxCategories is not None:
            self._set(maxCategories=int(maxCategories))

    def present(self, dataset: DataFrame) -> tuple[list[str], list[str]]:
        """(numeric, categorical) columns of ``dataset`` that are filled."""
        return tuple([c for c in self.getOrDefault(p) if c in dataset.columns] for p in (self.numericCols, self.categoricalCols))

    def _fit(self, dataset: DataFrame) -> "EncounterImputerModel":
        num, cat = self.present(dataset)
        means = numeric_means(dataset, num).first().asDict() if num else {}  # one row
        modes = column_modes(dataset, cat, with_cardinality=True).collect() if cat else []  # one row per column
        return self.model(dataset, means, {r["column_name"]: (r["mode_value"], r["n_distinct"]) for r in modes})

    def model(self, dataset: DataFrame, means: Mapping[str, float | None], modes: Mapping[str, tuple[str, int]]) -> "EncounterImputerModel":
        """The fitted model, given the mean of each numeric column and (mode, distinct values) of each categorical one."""
        num, cat = self.present(dataset)
        limit = self.getOrDefault(self.maxCategories)
        too_many = {c: n for c, (_, n) in modes.items() if limit and n > limit}
        if too_many:
            raise ValueError(f"categorical columns with more than {limit} distinct values "
                             f"(treat them as identifiers or group them first): {too_many}")
        fills = {c: math.trunc(means[c]) if isinstance(dataset.schema[c].dataType, T.IntegralType) else float(means[c])
                 for c in num if means.get(c) is not None}
        model = EncounterImputerModel(numericFill=json.dumps(fills), categoricalFill=json.dumps({c: v for c, (v, _) in modes.items()}))
        model._set(numericCols=num, categoricalCols=cat)
        return model


class EncounterImputerModel(Model, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    numericFill = Param(Params._dummy(), "numericFill", "JSON map column -> mean fill",
                        typeConverter=TypeConverters.toString)
    categoricalFill = Param(Params._dummy(), "categoricalFill", "JSON map column -> mode fill",
                            typeConverter=TypeConverters.toString)

    def __init__(self, numericFill: str = "{}", categoricalFill: str = "{}"):
        super().__init__()
        self._set(numericFill=numericFill, categoricalFill=categoricalFill)

    def fill_values(self) -> dict[str, object]:
        return {**json.loads(self.getOrDefault(self.numericFill)),
                **json.loads(self.getOrDefault(self.categoricalFill))}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fills = self.fill_values()
        cols = []
        for c in dataset.columns:
            if c in fills:
                dt = dataset.schema[c].dataType
                cols.append(F.coalesce(F.col(q(c)), F.lit(fills[c]).cast(dt)).alias(c))
            else:
                cols.append(F.col(q(c)))
        return dataset.select(*cols)


def fit_imputer(df: DataFrame, numeric: Sequence[str] = tuple(NUMERIC_COLUMNS),
                categorical: Sequence[str] = tuple(CATEGORICAL_COLUMNS)) -> EncounterImputerModel:
    return EncounterImputer(numericCols=numeric, categoricalCols=categorical).fit(df)


def apply_imputer(df: DataFrame, model: EncounterImputerModel) -> DataFrame:
    return model.transform(df)


def impute(df: DataFrame, numeric: Sequence[str] = tuple(NUMERIC_COLUMNS),
           categorical: Sequence[str] = tuple(CATEGORICAL_COLUMNS)) -> DataFrame:
    """Fit on ``df`` and fill ``df`` (statistics of the frame itself)."""
    return apply_imputer(df, fit_imputer(df, numeric, categorical))
