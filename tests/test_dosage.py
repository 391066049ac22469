"""Dosage rules and the classifier."""

from __future__ import annotations

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors

from tallyloom.functions.dosage_rules import frequency_ok, ndc11_format, strength_ok
from tallyloom.operators import dosage, dosage_model
from tallyloom.session import scratch_path, spread
from tallyloom.sources.files import DOSAGE_SCHEMA, read_dosage_file


def flags(spark, rule, values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(rule("v")).collect()]


def test_field_rules(spark):
    assert flags(spark, strength_ok, ["500 mg", "0.5 MCG", "10%", "5iu", "five mg", "5 mgs", "", None]) == [
        True, True, True, True, False, False, False, False,
    ]
    good = ["twice daily", "3 times per day", "1 time daily", "every 8 hours", "every 2 days", "Once Daily", "as needed",
            "with meal", "FOUR TIMES DAILY", "three time daily"]
    assert all(flags(spark, frequency_ok, good))
    assert not any(flags(spark, frequency_ok, ["often", "as needed twice", "every hour", "x twice daily", None]))
    assert flags(spark, ndc11_format, ["12345678901", "1234567890", "1234567890a", "123456789012", None]) == [
        True, False, False, False, False,
    ]


def rows(spark):
    return spark.createDataFrame(
        [
            ("12345678901", "Amoxicillin", "500 mg", "tablet", "oral", 30.0, "tablets", "twice daily"),
            ("12345678902", "Amoxicillin", "five mg", "tablet", "oral", 30.0, "tablets", "often"),
            ("99999678901", "Amoxicillin", "five mg", "tablet", "oral", 30.0, "tablets", "often"),
            ("1234567890", "Amoxicillin", "500 mg", "tablet", "oral", 30.0, "tablets", "twice daily"),
        ],
        DOSAGE_SCHEMA,
    )


def test_validation_stops_at_a_bad_code(spark):
    labelers = spark.createDataFrame([("12345",), ("12345",)], "labeler string")
    found = {r["ndc11"]: r for r in dosage.validate_dosage(rows(spark), labelers).collect()}
    assert found["12345678901"]["is_valid"] and found["12345678901"]["warnings"] == []
    assert found["12345678902"]["is_valid"]
    assert found["12345678902"]["warnings"] == ["Unusual strength format", "Unusual frequency pattern"]
    for bad in ("99999678901", "1234567890"):
        assert not found[bad]["is_valid"] and found[bad]["errors"] == ["Invalid NDC-11 code"]
        assert found[bad]["warnings"] == []
    assert dosage.known_labeler(rows(spark), labelers).count() == 3
    parts = {r["ndc11"]: r for r in dosage.parse_ndc11(rows(spark), labelers).collect()}
    good = parts["12345678901"]
    assert (good["labeler"], good["product"], good["package"], good["ndc_error"]) == ("12345", "6789", "01", None)
    assert parts["1234567890"]["labeler"] is None and parts["1234567890"]["ndc_error"]


@pytest.fixture(scope="module")
def training(spark):
    kinds = {"tablet": ("Amoxicillin", "500 mg", "oral"), "cream": ("Hydrocortisone", "1%", "topical"),
             "solution": ("Saline", "9 mL", "intravenous")}
    data = [
        (f"1234567{i:04d}", f"{name} {i % 3}", strength, form, route, 1.0, "x", "twice daily")
        for i, (form, (name, strength, route)) in enumerate(list(kinds.items()) * 20)
    ]
    return spark.createDataFrame(data, DOSAGE_SCHEMA)


def test_classifier_learns_and_survives_saving(spark, training):
    model = dosage_model.train_classifier(training, max_iter=20, features=256)
    path = dosage_model.save_model(model, scratch_path(spark, "model"))
    loaded = dosage_model.load_model(path)
    scored = dosage_model.predict_form(training, loaded).collect()
    assert all(r["predicted_dosage_form"] == r["dosage_form"] and 1 / 3 < r["confidence"] <= 1 for r in scored)
    labelers = spark.createDataFrame([("12345",)], "labeler string")
    wrong = training.limit(1).selectExpr("ndc11", "drug_name", "strength", "'gel' as dosage_form", "route", "quantity", "unit", "'often' as frequency")
    row = dosage.validate_dosage(wrong, labelers, loaded).first()
    assert row["is_valid"] and row["warnings"] == [
        f"Predicted dosage form ({row['predicted_dosage_form']}) differs from input", "Unusual frequency pattern",
    ]
    assert row["confidence"] > 0.5


def test_labels_and_features(spark, training):
    indexer = dosage_model.index_label(training)
    keyed = dosage_model.restore_label(indexer.transform(training), indexer.labels, "label", "back")
    assert keyed.where("back <> dosage_form").isEmpty()
    from pyspark.ml import Pipeline

    fitted = Pipeline(stages=dosage_model.featurize_text("drug_name", 64)).fit(training)
    vector = fitted.transform(training).select(vector_to_array("drug_name_features").alias("v")).first()["v"]
    assert len(vector) == 3 * 64 and sum(x * x for x in vector) == pytest.approx(3.0)


def test_file_by_position(spark):
    path = scratch_path(spark, "csv")
    row = ("00000000001", "Something", "5 mg", "capsule", "oral", 3.0, "capsules", "twice daily")
    spark.createDataFrame([row], DOSAGE_SCHEMA).write.csv(path)
    assert read_dosage_file(spark, path).first()["frequency"] == "twice daily"


def test_lengths_visit_stored_values_only(spark):
    made = [Vectors.dense([3.0, 0.0, 4.0]), Vectors.sparse(5000, {1: 2.0, 4999: 3.0}), Vectors.sparse(7, {})]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(made)], ["i", "v"])
    measured = frame.select("i", dosage_model.dimensions("v"), dosage_model.squared_length("v"))
    assert sorted(tuple(r) for r in measured.collect()) == [(0, 3, 25.0), (1, 5000, 13.0), (2, 7, 0.0)]


def test_a_small_file_of_many_rows_is_worked_on_by_many_tasks(spark):
    one = spark.range(25_000).selectExpr("cast(id as string) drug_name", "'5 mg' strength", "'oral' route", "if(id % 2 = 0, 'a', 'b') dosage_form").coalesce(1)
    dealt = spread(one)
    assert dealt.rdd.getNumPartitions() == 3 and dealt.exceptAll(one).count() == 0 == one.exceptAll(dealt).count()
    assert spread(one.limit(9)).rdd.getNumPartitions() == 1
    model = dosage_model.train_classifier(one.where("drug_name < '2'"), max_iter=1, features=16)
    assert dosage_model.predict_form(one, model).rdd.getNumPartitions() == 3
