"""Feature pipeline (M1-M5, P17, Q17) on MLlib stages.

One multi-column ``StringIndexer`` counts the levels of every categorical
column in a single pass (one job, where one indexer per column costs one
job each).  The one-hot encoder drops its last slot, which with
``handleInvalid="keep"`` is the unseen/NULL slot: every level seen in
training keeps a slot and an unseen or NULL value becomes all zeros.
Rows with a NULL/NaN numeric feature are skipped by the assembler and
counted by ``usable_rows``.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CATEGORICAL_FEATURES, LEAKY_COLUMNS, NUMERIC_FEATURES
from ..sources.files import rows_to_table
from . import cells as CE


class LeakageError(ValueError):
    """A label-derived column was asked for as a feature."""


def check_no_leakage(features, denied=LEAKY_COLUMNS) -> None:
    """Raise when a denied (label-derived) column is among the features."""
    bad = sorted(set(features) & set(denied))
    if bad:
        raise LeakageError(f"label-derived columns cannot be features: {bad}")


def feature_stages(numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES,
                   out: str = "features", denied=LEAKY_COLUMNS):
    """M1-M3: indexer (all categoricals at once), one-hot (drop last), assembler (skip)."""
    check_no_leakage(list(numeric) + list(categorical), denied)
    idx = [f"{c}_idx" for c in categorical]
    ohe = [f"{c}_ohe" for c in categorical]
    stages = []
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=idx,
                                    handleInvalid="keep", stringOrderType="frequencyDesc"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True))
    stages.append(VectorAssembler(inputCols=list(numeric) + ohe, outputCol=out,
                                  handleInvalid="skip"))
    return stages


def fit_features(train: DataFrame, numeric=NUMERIC_FEATURES,
                 categorical=CATEGORICAL_FEATURES, out: str = "features") -> PipelineModel:
    """M4: fit the stages on the training rows only."""
    return Pipeline(stages=feature_stages(numeric, categorical, out)).fit(train)


def slot_names(fitted: PipelineModel) -> list[str]:
    """M5: slot index -> name, from the labels that the fitted indexer found and the assembler's inputs.

    A one-hot column has a slot per label (the bucket for unseen values is the
    dropped last one); any other input is one slot.
    """
    labels: dict[str, list[str]] = {}
    for stage in fitted.stages:
        if isinstance(stage, StringIndexerModel):
            labels |= {c: list(found) for c, found in zip(stage.getOutputCols(), stage.labelsArray)}
        elif isinstance(stage, OneHotEncoderModel):
            labels = {encoded: labels[c] for c, encoded in zip(stage.getInputCols(), stage.getOutputCols())}
    names: list[str] = []
    for c in fitted.stages[-1].getInputCols():
        names += [f"{c}_{label}" for label in labels[c]] if c in labels else [c]
    return names


def slot_table(spark: SparkSession, names) -> DataFrame:
    """M5 as a table (slot, feature); bounded by the vector width."""
    schema = T.StructType([T.StructField("slot", T.IntegerType()),
                           T.StructField("feature", T.StringType())])
    return rows_to_table(spark, enumerate(names), schema)


def level_index(df: DataFrame, columns) -> DataFrame:
    """M1 as a table: (column_name, level, n, level_index), frequency order.

    Same order as ``StringIndexer(stringOrderType="frequencyDesc")``: count
    descending, ties alphabetical.  The facts are counted once by combination
    of the columns (``cells.py``); the cells are stacked and added up, and the
    ranking window runs per column over its levels only.
    """
    from pyspark.sql import Window
    counts = CE.values_of_cells(CE.value_cells(df, columns), columns).filter(F.col("level").isNotNull())
    w = Window.partitionBy("column_name").orderBy(F.desc("n"), F.asc("level"))
    return counts.withColumn("level_index", (F.row_number().over(w) - 1).cast("int"))
