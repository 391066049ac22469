"""Dosage validation over whole tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.columns import empty_strings, present
from tallyloom.functions.dosage_rules import (
    FREQUENCY_WARNING,
    NDC_ERROR,
    STRENGTH_WARNING,
    frequency_ok,
    labeler_of,
    ndc11_format,
    ndc11_parts,
    strength_ok,
)
from tallyloom.operators.dosage_model import predict_form


def known_labeler(df: DataFrame, labelers: DataFrame, code: str = "ndc11") -> DataFrame:
    """Keep the rows whose labeler is in ``labelers.labeler``."""
    return df.withColumn("_labeler", labeler_of(code)).join(
        labelers.select(F.col("labeler").alias("_labeler")), "_labeler", "left_semi"
    ).drop("_labeler")


def with_known_labeler(df: DataFrame, labelers: DataFrame, code: str = "ndc11", flag: str = "labeler_known") -> DataFrame:
    """Add a flag that tells whether the labeler is in ``labelers.labeler``."""
    known = labelers.select(F.col("labeler").alias("_labeler")).distinct().withColumn("_known", F.lit(True))
    return (
        df.withColumn("_labeler", labeler_of(code))
        .join(known, "_labeler", "left")
        .withColumn(flag, F.col("_known").isNotNull())
        .drop("_labeler", "_known")
    )


def _with_valid_code(df: DataFrame, labelers: DataFrame, code: str) -> DataFrame:
    flagged = with_known_labeler(df, labelers, code, "_known_labeler")
    return flagged.withColumn("_code_ok", ndc11_format(code) & F.col("_known_labeler")).drop("_known_labeler")


def parse_ndc11(df: DataFrame, labelers: DataFrame, code: str = "ndc11") -> DataFrame:
    """Add ``labeler, product, package`` and ``ndc_error``; parts are null on a bad code."""
    checked = _with_valid_code(df, labelers, code)
    return (
        checked.withColumns(ndc11_parts(code, F.col("_code_ok")))
        .withColumn("ndc_error", F.when(~F.col("_code_ok"), F.lit(NDC_ERROR)))
        .drop("_code_ok")
    )


def form_mismatch_warning(predicted: Column, form: Column) -> Column:
    """Warning text where a prediction differs from the stated form, else null."""
    return F.when(
        predicted.isNotNull() & ~predicted.eqNullSafe(form),
        F.concat(F.lit("Predicted dosage form ("), predicted, F.lit(") differs from input")),
    )


def validate_dosage(df: DataFrame, labelers: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """Add ``is_valid, predicted_dosage_form, confidence, warnings, errors``.

    A bad drug code is the only error; it ends the check, so such rows carry
    neither warnings nor a prediction.
    """
    checked = _with_valid_code(df, labelers, "ndc11")
    if model is None:
        predicted = checked.withColumns(
            {"_form": F.lit(None).cast("string"), "_score": F.lit(None).cast("double")}
        )
    else:
        predicted = predict_form(checked, model, "_form", "_score")
    ok = F.col("_code_ok")
    warnings = present(
        F.when(~strength_ok("strength"), F.lit(STRENGTH_WARNING)),
        form_mismatch_warning(F.col("_form"), F.col("dosage_form")),
        F.when(~frequency_ok("frequency"), F.lit(FREQUENCY_WARNING)),
    )
    return predicted.select(
        *df.columns,
        ok.alias("is_valid"),
        F.when(ok, F.col("_form")).alias("predicted_dosage_form"),
        F.when(ok, F.coalesce("_score", F.lit(0.0))).otherwise(F.lit(0.0)).cast("float").alias("confidence"),
        F.when(ok, warnings).otherwise(empty_strings()).alias("warnings"),
        F.when(ok, empty_strings()).otherwise(F.array(F.lit(NDC_ERROR))).alias("errors"),
    )
