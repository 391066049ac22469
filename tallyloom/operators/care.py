"""Care and treatment plans shaped from preference and examination columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.columns import as_column, empty_strings

PREFERENCES_SCHEMA = (
    "preferred_treatment_approach string, comfort_priorities array<string>,"
    " scheduling_needs string, interested_in_research boolean"
)

# Fixed values of the plans.
NO_PARTICIPATION = "None - patient preference"
OPT_OUT = "Available at any time"
CLEANING_FREQUENCY = "6 months"
X_RAYS = "yearly"
FLUORIDE = "as needed"
TIMELINE = "12 months"


def care_plan(df: DataFrame, preferences: str = "preferences", output: str = "treatment_plan") -> DataFrame:
    """Nested plan from the preferences; missing preferences are null."""
    wish = F.col(preferences)
    return df.withColumn(
        output,
        F.struct(
            wish["preferred_treatment_approach"].alias("primary_treatment"),
            wish["comfort_priorities"].alias("comfort_measures"),
            wish["scheduling_needs"].alias("schedule_flexibility"),
        ),
    )


def research_participation(interested: Column | str) -> Column:
    """``participation`` text without interest, ``opt_out_protocol`` with it."""
    wanted = F.coalesce(as_column(interested), F.lit(False))
    return F.struct(
        F.when(~wanted, F.lit(NO_PARTICIPATION)).alias("participation"),
        F.when(wanted, F.lit(OPT_OUT)).alias("opt_out_protocol"),
    )


def treatment_plan(df: DataFrame, examination: str = "examination", output: str = "treatment_plan") -> DataFrame:
    """Preventive constants and the needs found; missing lists are empty."""
    exam = F.col(examination)

    def listed(field: str) -> Column:
        return F.coalesce(exam[field], empty_strings())

    return df.withColumn(
        output,
        F.struct(
            F.struct(
                F.lit(CLEANING_FREQUENCY).alias("cleaning_frequency"),
                F.lit(X_RAYS).alias("x_rays"),
                F.lit(FLUORIDE).alias("fluoride"),
            ).alias("preventive_care"),
            listed("restorative_needs").alias("restorative_care"),
            listed("referral_needs").alias("specialist_referrals"),
            F.lit(TIMELINE).alias("estimated_timeline"),
            listed("priority_treatments").alias("priority_procedures"),
        ),
    )
