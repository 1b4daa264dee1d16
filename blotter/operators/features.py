"""Feature engineering with MLlib: category indexes (most frequent first,
ties alphabetical, invalid rows skipped) and the feature vector
[hour, district, kind index, domestic index].

Indexes are fitted by MLlib's own multi-column indexer: one aggregate over
all columns, each with its own label list. The label lists live in the model
on the driver, as in any ``StringIndexer``. How many categories a learner can
bin is the learner's limit and is checked where one is fitted
(``models.fit_all``), not here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.sources import schema as S

KIND_IDX = "kind_idx"
DOMESTIC_IDX = "domestic_idx"
FEATURES = "features"
FEATURE_ORDER = (S.HOUR, S.DISTRICT, KIND_IDX, DOMESTIC_IDX)
CATEGORY_INPUTS = (S.KIND, S.DOMESTIC_STR)
CATEGORY_OUTPUTS = (KIND_IDX, DOMESTIC_IDX)

def category_indexer(
    inputs: Sequence[str] = CATEGORY_INPUTS,
    outputs: Sequence[str] = CATEGORY_OUTPUTS,
    handle_invalid: str = "skip",
) -> StringIndexer:
    return StringIndexer(
        inputCols=list(inputs),
        outputCols=list(outputs),
        handleInvalid=handle_invalid,
        stringOrderType="frequencyDesc",
    )


def feature_assembler(inputs: Sequence[str] = FEATURE_ORDER, output: str = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=list(inputs), outputCol=output, handleInvalid="error")


def feature_stages(inputs=CATEGORY_INPUTS, outputs=CATEGORY_OUTPUTS, order=FEATURE_ORDER, output=FEATURES):
    """Unfitted indexer + assembler for a plain ``Pipeline``."""
    return [category_indexer(inputs, outputs), feature_assembler(order, output)]


def fit_indexer(train: DataFrame, inputs: Sequence[str], outputs: Sequence[str], handle_invalid: str = "skip") -> StringIndexerModel:
    return category_indexer(inputs, outputs, handle_invalid).fit(train)


def fit_features(train: DataFrame) -> PipelineModel:
    """Indexers fitted once on the training rows, then the assembler; the
    fitted model is shared by every classifier."""
    return PipelineModel(stages=[fit_indexer(train, CATEGORY_INPUTS, CATEGORY_OUTPUTS), feature_assembler()])


def category_sizes(vectors: DataFrame, features: str = FEATURES) -> dict[str, int]:
    """Categories of each indexed element of a vector column, by its name,
    from the column's metadata (no job)."""
    attrs = vectors.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    return {a["name"]: len(a["vals"]) for a in attrs.get("nominal", [])}


def vector_elements(df: DataFrame, vector_col: str, names: Sequence[str], prefix: str = "f_") -> DataFrame:
    """Replace a vector column by one double column per element."""
    arr = vector_to_array(F.col(vector_col))
    return df.select(
        *[c for c in df.columns if c != vector_col],
        *[arr[i].alias(prefix + n) for i, n in enumerate(names)],
    )


def index_counts(indexed: DataFrame, value: str, index: str) -> DataFrame:
    """(value, index, rows) of an indexed frame: the index map with support."""
    return indexed.groupBy(value, index).agg(F.count(F.lit(1)).alias("n_rows"))
