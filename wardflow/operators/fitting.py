"""Imputer, class balance and category indexes fitted together, from one pass over the cleaned rows.

Everything these stages learn is a function of how often each value of a column
occurs, so one table of frequencies replaces a pass for each stage: the fill of
a column is its most frequent value, its NULLs count for that value when the
categories are ranked, a mean is the weighted mean of the counted values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.operators.encode import CategoryIndexer
from wardflow.operators.impute import EncounterImputer, EncounterImputerModel
from wardflow.operators.profile import modes_of, numeric_means, value_frequencies
from wardflow.schema import CATEGORICAL_COLUMNS, LABEL, NUMERIC_COLUMNS
from wardflow.session import written

ROWS = "__rows"


class Fitted(NamedTuple):
    imputer: EncounterImputerModel
    indexer: CategoryIndexer | None
    n_positive: int
    n_negative: int


def fit_together(cleaned: DataFrame, features: Callable[[DataFrame], DataFrame], categories: Sequence[str], label: str = LABEL,
                 imputer: EncounterImputer | None = None) -> Fitted:
    """What ``imputer`` learns on ``cleaned``, and the indexer of ``categories`` and the label's counts on ``features`` of the filled rows.

    ``features`` has to keep the imputed columns and to derive no category from one of them. The frequencies are
    written once (a row for each distinct value); the labels come to the driver, as they do when MLlib fits its indexer.
    """
    imputer = imputer or EncounterImputer(numericCols=NUMERIC_COLUMNS, categoricalCols=CATEGORICAL_COLUMNS)
    num, cat = imputer.present(cleaned)
    rows = features(cleaned)
    whole = [c for c in num if isinstance(cleaned.schema[c].dataType, T.IntegralType)]
    counted = list(dict.fromkeys([*categories, *cat, *whole, *([label] if label in rows.columns else [])]))
    frequencies = written(value_frequencies(rows.withColumn(ROWS, F.lit("")), [*counted, ROWS]), "frequencies")

    n, value = F.col("n"), F.col("value")
    of = {r["column_name"]: r for r in modes_of(frequencies, mean=F.try_divide(F.sum(value.try_cast("double") * n), F.sum(n)),
                                                n_known=F.sum(n)).collect()}  # one row per column
    total = of[ROWS]["n_known"] if ROWS in of else 0
    means = {c: of[c]["mean"] for c in whole if c in of}
    rest = [c for c in num if c not in whole]
    if rest:
        means |= numeric_means(cleaned, rest).first().asDict()
    imputer_model = imputer.model(cleaned, means, {c: (of[c]["mode_value"], of[c]["n_distinct"]) for c in cat if c in of})

    labels: dict[str, dict[str, int]] = {c: {} for c in categories}
    balance = dict.fromkeys((0.0, 1.0), 0)
    for r in frequencies.where(F.col("column_name").isin([*categories, label])).collect():  # the indexers' labels
        if r["column_name"] in labels:
            labels[r["column_name"]][r["value"]] = r["n"]
        elif float(r["value"]) in balance:
            balance[float(r["value"])] += r["n"]
    for c in set(cat) & set(labels):
        if labels[c]:
            labels[c][of[c]["mode_value"]] += total - of[c]["n_known"]  # its NULLs are filled with the mode
    return Fitted(imputer_model, ranked(categories, labels), balance[1.0], balance[0.0])


def ranked(categories: Sequence[str], labels: dict[str, dict[str, int]]) -> CategoryIndexer | None:
    """An indexer with the labels that :func:`encode.index_categories` finds on rows with these frequencies: most frequent first, ties in Java's string order."""
    if not categories:
        return None
    return CategoryIndexer(categories, [sorted(labels[c], key=lambda v: (-labels[c][v], v.encode("utf-16-be"))) for c in categories])
