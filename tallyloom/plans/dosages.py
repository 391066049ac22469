"""Dosage rules and the dosage-form classifier over parts."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions.dosage_rules import frequency_ok, ndc11_format, strength_ok
from tallyloom.operators import dosage, dosage_model
from tallyloom.plans.inputs import DOSAGES_SQL, FREQUENCIES, LABELERS_SQL, dosages, labelers
from tallyloom.plans.registry import query
from tallyloom.session import scratch_path, spread
from tallyloom.sources.files import read_dosage_file

STRENGTH_SQL = r"regexp_matches(strength, '^\d+(\.\d+)?\s*(mg|g|mcg|mL|%|unit|IU)$', 'i')"
FREQUENCY_SQL = (
    r"regexp_matches(frequency, '^(\d+\s*times?\s*(daily|per\s*day)|every\s*\d+\s*(hours?|days?)|once\s*daily"
    r"|twice\s*daily|three\s*times?\s*daily|four\s*times?\s*daily|as\s*needed|with\s*meals?)$', 'i')"
)
CODE_SQL = rf"(regexp_matches(ndc11, '^\d{{11}}$') and substr(ndc11, 1, 5) in ({LABELERS_SQL}))"


@query(f"""
select ndc11, case when {CODE_SQL} then substr(ndc11, 1, 5) end as labeler,
       case when {CODE_SQL} then substr(ndc11, 6, 4) end as product,
       case when {CODE_SQL} then substr(ndc11, 10, 2) end as package,
       case when not {CODE_SQL} then 'Invalid NDC-11 code' end as ndc_error
from ({DOSAGES_SQL})
""")
def parse_drug_codes(spark: SparkSession, folder: str) -> DataFrame:
    parsed = dosage.parse_ndc11(dosages(spark, folder), labelers(spark, folder))
    return parsed.select("ndc11", "labeler", "product", "package", "ndc_error")


@query(f"select ndc11, drug_name from ({DOSAGES_SQL}) where substr(ndc11, 1, 5) in ({LABELERS_SQL})")
def dosages_of_known_labelers(spark: SparkSession, folder: str) -> DataFrame:
    known = dosage.known_labeler(dosages(spark, folder), labelers(spark, folder))
    return known.select("ndc11", "drug_name")


@query(rf"""
select ndc11, strength, frequency, regexp_matches(ndc11, '^\d{{11}}$') as code_format, {STRENGTH_SQL} as strength_ok,
       {FREQUENCY_SQL} as frequency_ok
from ({DOSAGES_SQL})
""")
def dosage_field_rules(spark: SparkSession, folder: str) -> DataFrame:
    return dosages(spark, folder).select(
        "ndc11",
        "strength",
        "frequency",
        ndc11_format("ndc11").alias("code_format"),
        strength_ok("strength").alias("strength_ok"),
        frequency_ok("frequency").alias("frequency_ok"),
    )


VALIDATED_SQL = f"""
select ndc11, drug_name, {CODE_SQL} as is_valid, null::varchar as predicted_dosage_form, 0::float as confidence,
       case when {CODE_SQL} then concat_ws(';', case when not {STRENGTH_SQL} then 'Unusual strength format' end,
                                           case when not {FREQUENCY_SQL} then 'Unusual frequency pattern' end)
            else '' end as warnings,
       case when {CODE_SQL} then '' else 'Invalid NDC-11 code' end as errors
from ({DOSAGES_SQL})
"""


def _flat(validated: DataFrame) -> DataFrame:
    return validated.select(
        "ndc11",
        "drug_name",
        "is_valid",
        "predicted_dosage_form",
        "confidence",
        F.array_join("warnings", ";").alias("warnings"),
        F.array_join("errors", ";").alias("errors"),
    )


@query(VALIDATED_SQL)
def validate_dosages(spark: SparkSession, folder: str) -> DataFrame:
    """The rules without a trained model."""
    return _flat(dosage.validate_dosage(dosages(spark, folder), labelers(spark, folder)))


@query()
def validate_dosages_with_model(spark: SparkSession, folder: str) -> DataFrame:
    """The rules with a classifier trained on the same table."""
    rows = dosages(spark, folder)
    model = dosage_model.train_classifier(rows, max_iter=10, features=1 << 10)
    return _flat(dosage.validate_dosage(rows, labelers(spark, folder), model))


@query()
def predict_with_saved_model(spark: SparkSession, folder: str) -> DataFrame:
    """Forms predicted by a model that was trained, saved and loaded."""
    rows = dosages(spark, folder)
    path = scratch_path(spark, "model")
    dosage_model.save_model(dosage_model.train_classifier(rows, max_iter=10, features=1 << 10), path)
    model: PipelineModel = dosage_model.load_model(path)
    return dosage_model.predict_form(rows, model).select("ndc11", "dosage_form", "predicted_dosage_form", "confidence")


UNIT_FORMS = ("ECONOMY", "STANDARD", "PROMO")
_FIRST = FREQUENCIES[0]


@query(f"""
select ndc11, stated as dosage_form, dosage_form as predicted_dosage_form, true as is_share,
       case when stated <> dosage_form then 'Predicted dosage form (' || dosage_form || ') differs from input' end as warning
from (select *, case when frequency = '{_FIRST}' then 'SOMETHING ELSE' else dosage_form end as stated
      from ({DOSAGES_SQL}) where dosage_form in {UNIT_FORMS})
""")
def forms_told_by_unit(spark: SparkSession, folder: str) -> DataFrame:
    """A trained, saved and loaded model on the forms that the unit of the strength decides; some rows state another form."""
    rows = dosages(spark, folder).where(F.col("dosage_form").isin(*UNIT_FORMS))
    path = scratch_path(spark, "model")
    dosage_model.save_model(dosage_model.train_classifier(rows, max_iter=30, features=1 << 10), path)
    stated = F.when(F.col("frequency") == _FIRST, F.lit("SOMETHING ELSE")).otherwise(F.col("dosage_form"))
    predicted = dosage_model.predict_form(rows.withColumn("dosage_form", stated), dosage_model.load_model(path))
    return predicted.select(
        "ndc11",
        "dosage_form",
        "predicted_dosage_form",
        F.col("confidence").between(0.0, 1.0).alias("is_share"),
        dosage.form_mismatch_warning(F.col("predicted_dosage_form"), F.col("dosage_form")).alias("warning"),
    )


@query(f"""
select dosage_form, label, dosage_form as restored, count(*) as rows
from ({DOSAGES_SQL}) join
     (select dosage_form, (row_number() over (order by count(*) desc, dosage_form) - 1)::double as label
      from ({DOSAGES_SQL}) group by 1) using (dosage_form)
group by all
""")
def dosage_form_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Label keys by frequency, and back."""
    rows = dosages(spark, folder)
    indexer = dosage_model.index_label(rows)
    keyed = dosage_model.restore_label(indexer.transform(rows), indexer.labels, "label", "restored")
    return keyed.groupBy("dosage_form", "label", "restored").agg(F.count(F.lit(1)).alias("rows"))


def _parts_sql(text: str) -> str:
    """How many of words, word pairs and character triples a text has."""
    return f"(1 + (contains({text}, ' '))::integer + (length({text}) >= 3)::integer)"


@query(f"""
select ndc11, 2304 as dimensions,
       ({_parts_sql('drug_name')} + {_parts_sql('strength')} + {_parts_sql('route')})::double as squared_length
from ({DOSAGES_SQL})
""")
def dosage_text_features(spark: SparkSession, folder: str) -> DataFrame:
    """Dimensions and squared length of the joined text features: one for each part a text has."""
    rows = spread(dosages(spark, folder))
    stages = [stage for column in dosage_model.TEXT_COLUMNS for stage in dosage_model.featurize_text(column, 1 << 8)]
    features = Pipeline(stages=[*stages, dosage_model.concat_features()]).fit(rows).transform(rows)
    return features.select(
        "ndc11",
        dosage_model.dimensions("features").alias("dimensions"),
        F.round(dosage_model.squared_length("features"), 6).alias("squared_length"),
    )


@query(f"select * from ({DOSAGES_SQL})")
def dosage_file_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Dosages written as delimited files and read back by position."""
    path = scratch_path(spark, "dosages")
    dosages(spark, folder).write.csv(path)
    return read_dosage_file(spark, path)
