"""Feature encoding with MLlib: one multi-column StringIndexer, one multi-column
OneHotEncoder and a VectorAssembler, nested in a Pipeline with a classifier.

Fitting the indexer is one aggregate job for all columns (per-column indexers
would launch one job each).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Pipeline, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.schema import q

FEATURES = "features"
SEARCHED_LABELS = 64  # a column of more labels is indexed by MLlib's hash lookup


def index_categories(cols: Sequence[str], handle_invalid: str = "keep") -> StringIndexer:
    """Most frequent value -> 0, ties alphabetical; unseen and NULL -> one extra last index."""
    return StringIndexer(inputCols=list(cols), outputCols=[f"{c}_index" for c in cols],
                         handleInvalid=handle_invalid, stringOrderType="frequencyDesc")


class CategoryIndexer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """What a fitted :func:`index_categories` with ``keep`` does, as built-in expressions: the place of a value in its column's labels.

    MLlib's model calls a Scala function for each value. Here columns of few labels search a constant array in
    generated code, most frequent label first; the others go through MLlib's model of the same labels.
    """

    inputCols = Param(Params._dummy(), "inputCols", "columns to index", typeConverter=TypeConverters.toListString)
    labels = Param(Params._dummy(), "labels", "JSON list of each column's labels, most frequent first", typeConverter=TypeConverters.toString)

    def __init__(self, inputCols: Sequence[str] = (), labelsArray: Sequence[Sequence[str]] = ()):
        super().__init__()
        self._set(inputCols=list(inputCols), labels=json.dumps([list(x) for x in labelsArray]))

    @property
    def labelsArray(self) -> list[list[str]]:
        return json.loads(self.getOrDefault(self.labels))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        every = {c: x for c, x in zip(self.getOrDefault(self.inputCols), self.labelsArray) if c in dataset.columns}
        many = {c: x for c, x in every.items() if len(x) > SEARCHED_LABELS}
        few = {f"{c}_index": self._index(c, x) for c, x in every.items() if c not in many}
        out = dataset.select("*", *few.values()) if few else dataset
        return string_indexer_model(list(many), list(many.values())).transform(out) if many else out

    @staticmethod
    def _index(c: str, labels: Sequence[str]):
        out = f"{c}_index"
        at = F.lit(0)
        if labels:
            at = F.array_position(F.array(*map(F.lit, labels)), F.col(q(c)).cast("string"))  # 0: not among them
            at = F.coalesce(F.pmod(at - 1, F.lit(len(labels) + 1)), F.lit(len(labels)))
        return at.cast("double").alias(out, metadata={"ml_attr": {"vals": [*labels, "__unknown"], "type": "nominal", "name": out}})


def string_indexer_model(cols: Sequence[str], labels: Sequence[Sequence[str]]) -> StringIndexerModel:
    """MLlib's model of :func:`index_categories` with given labels."""
    unfitted = index_categories(cols)
    text = SparkSession.getActiveSession().sparkContext._jvm.java.lang.String
    arrays = StringIndexerModel._new_java_array([[] for _ in cols], text)  # jagged: from_arrays_of_labels fills shorter lists up with nulls
    for i, known in enumerate(labels):
        arrays[i] = StringIndexerModel._new_java_array(list(known), text)
    model = StringIndexerModel._create_from_java_class("org.apache.spark.ml.feature.StringIndexerModel", arrays)
    return model.setInputCols(unfitted.getInputCols()).setOutputCols(unfitted.getOutputCols()).setHandleInvalid(unfitted.getHandleInvalid())


def one_hot(cols: Sequence[str], drop_last: bool = True) -> OneHotEncoder:
    """One-hot of ``<c>_index``; with ``drop_last`` the extra 'keep' index is the zero vector."""
    return OneHotEncoder(inputCols=[f"{c}_index" for c in cols], outputCols=[f"{c}_vec" for c in cols],
                         dropLast=drop_last)


def assemble(categorical: Sequence[str], numeric: Sequence[str], out: str = FEATURES) -> VectorAssembler:
    """All one-hot vectors then the numeric columns; a NULL numeric is an error (impute first)."""
    return VectorAssembler(inputCols=[f"{c}_vec" for c in categorical] + list(numeric), outputCol=out,
                           handleInvalid="error")


def encoding_stages(roles: dict[str, list[str]]) -> list:
    cat, num = roles["categorical"], roles["numeric"]
    stages = []
    if cat:
        stages += [index_categories(cat), one_hot(cat)]
    stages.append(assemble(cat, num))
    return stages


def active_slots(vector: str):
    """``array<struct<slot, value>>`` of a vector's non-zero entries, without filling in its zeros.

    A sparse vector's own indices and values are used; a dense one (which MLlib
    makes when that is smaller) gets the places of its values as indices.
    """
    v = F.unwrap_udt(F.col(vector))
    at = F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1))
    pairs = F.arrays_zip(at.alias("slot"), v["values"].alias("value"))
    return F.filter(F.when(F.size(v["values"]) > 0, pairs).otherwise(F.array().cast("array<struct<slot:int,value:double>>")),
                    lambda x: x["value"] != 0.0)


def hot_slot(vector: str):
    """The first active slot of a vector (a one-hot vector has one at most); NULL if it has none."""
    return F.get(active_slots(vector), F.lit(0))["slot"]


def vector_size(vector: str):
    v = F.unwrap_udt(F.col(vector))
    return F.coalesce(v["size"], F.size(v["values"]))


def build_encoder(roles: dict[str, list[str]]) -> Pipeline:
    return Pipeline(stages=encoding_stages(roles))


def build_pipeline(roles: dict[str, list[str]], estimator) -> Pipeline:
    """(encoding pipeline) + classifier, as one fit/transform unit."""
    return Pipeline(stages=[build_encoder(roles), estimator])


def check_cardinality(df: DataFrame, cols: Sequence[str], max_distinct: int) -> dict[str, int]:
    """Approximate distinct count of each categorical column, in one aggregate.

    The indexer fit brings every label of every column to the driver; this
    check proves that set is bounded before it is built, and names the
    columns that are identifiers rather than categories.
    """
    row = df.agg(*[F.approx_count_distinct(F.col(q(c)), 0.05).alias(c) for c in cols]).first()
    counts = {c: int(row[c]) for c in cols}
    too_many = {c: n for c, n in counts.items() if n > max_distinct}
    if too_many:
        raise ValueError(f"categorical columns with more than {max_distinct} distinct values "
                         f"(treat them as identifiers or group them first): {too_many}")
    return counts
