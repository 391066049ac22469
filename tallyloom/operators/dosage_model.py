"""Dosage-form classifier: text features and a maximum-entropy model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    HashingTF,
    IndexToString,
    NGram,
    Normalizer,
    RegexTokenizer,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.session import spread

TEXT_COLUMNS = ("drug_name", "strength", "route")
LABEL_COLUMN = "dosage_form"
SEED = 42


def index_label(df: DataFrame, label: str = LABEL_COLUMN, output: str = "label") -> StringIndexerModel:
    """Fit label keys, most frequent first; unseen labels get a key of their own."""
    return StringIndexer(inputCol=label, outputCol=output, handleInvalid="keep").fit(df)


def restore_label(df: DataFrame, labels: Sequence[str], key: str = "prediction", output: str = "label_text") -> DataFrame:
    """Turn label keys back into labels."""
    return IndexToString(inputCol=key, outputCol=output, labels=list(labels)).transform(df)


def featurize_text(column: str, features: int = 1 << 12) -> list:
    """Stages that turn a text column into ``<column>_features``.

    Words, word pairs and character triples are hashed, counted and scaled to
    unit length.
    """
    words, pairs, chars, triples = (f"_{column}_{part}" for part in ("words", "pairs", "chars", "triples"))
    hashed = [(words, f"{words}_tf"), (pairs, f"{pairs}_tf"), (triples, f"{triples}_tf")]
    scaled = [f"{output}_unit" for _, output in hashed]
    return [
        RegexTokenizer(inputCol=column, outputCol=words, pattern=r"\s+"),
        NGram(n=2, inputCol=words, outputCol=pairs),
        RegexTokenizer(inputCol=column, outputCol=chars, pattern=r"(?s).", gaps=False),
        NGram(n=3, inputCol=chars, outputCol=triples),
        *[HashingTF(inputCol=tokens, outputCol=output, numFeatures=features) for tokens, output in hashed],
        *[Normalizer(inputCol=output, outputCol=unit) for (_, output), unit in zip(hashed, scaled)],
        VectorAssembler(inputCols=scaled, outputCol=f"{column}_features"),
    ]


def concat_features(columns: Sequence[str] = TEXT_COLUMNS, output: str = "features") -> VectorAssembler:
    """Join the feature vectors of several text columns."""
    return VectorAssembler(inputCols=[f"{column}_features" for column in columns], outputCol=output)


def squared_length(vector: Column | str) -> Column:
    """Sum of the squares of a vector's values; only those that are stored are visited, not all dimensions."""
    stored = F.unwrap_udt(vector)["values"]
    return F.aggregate(stored, F.lit(0.0), lambda total, x: total + x * x)


def dimensions(vector: Column | str) -> Column:
    """Dimensions of a vector; a dense one has a value for each and doesn't state them."""
    stored = F.unwrap_udt(vector)
    return F.coalesce(stored["size"], F.size(stored["values"]))


def _without_null_text(df: DataFrame) -> DataFrame:
    return df.withColumns({column: F.coalesce(column, F.lit("")) for column in TEXT_COLUMNS})


def train_classifier(df: DataFrame, max_iter: int = 50, features: int = 1 << 12) -> PipelineModel:
    """Fit the whole chain on labelled dosage rows."""
    rows = _without_null_text(df.where(F.col(LABEL_COLUMN).isNotNull()).select(*TEXT_COLUMNS, LABEL_COLUMN))
    rows = spread(rows)
    indexer = StringIndexer(inputCol=LABEL_COLUMN, outputCol="label").fit(rows)
    stages = [stage for column in TEXT_COLUMNS for stage in featurize_text(column, features)]
    classifier = LogisticRegression(family="multinomial", maxIter=max_iter, regParam=1e-4)
    chain = Pipeline(stages=[*stages, concat_features(), classifier])
    fitted = chain.fit(indexer.transform(rows))
    restore = IndexToString(inputCol="prediction", outputCol="_restored", labels=indexer.labels)
    return PipelineModel([*fitted.stages, restore])


def max_confidence(scores: Column | str) -> Column:
    """The largest class score of a probability vector."""
    return F.array_max(vector_to_array(scores))


def predict_form(
    df: DataFrame, model: PipelineModel, form: str = "predicted_dosage_form", confidence: str = "confidence"
) -> DataFrame:
    """Add the predicted form and its confidence to every row."""
    scored = model.transform(_without_null_text(spread(df)))
    return scored.select(
        *[F.col(name) for name in df.columns],
        F.col("_restored").alias(form),
        max_confidence("probability").alias(confidence),
    )


def save_model(model: PipelineModel, path: str) -> str:
    """Write a fitted model, replacing an older one."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """Read a fitted model."""
    return PipelineModel.load(path)
