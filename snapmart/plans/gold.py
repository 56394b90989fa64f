"""Star tables from the conformed tables.

Each builder returns the table's fixed schema followed by ``period``, the folder
column. Text enters the serving layer with blanks as NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from snapmart.functions.codes import (
    clean_text, join_code_text, normalise_code, pad_code, replace_sentinel, zero_fill,
)
from snapmart.functions.dates import snapshot_key
from snapmart.operators.ids import (
    add_occurrence, add_position, natural_or_artificial, occurrence_text, row_sequence,
    stage_in_order,
)
from snapmart.operators.shape import coalesce_columns, enforce_schema
from snapmart.plans.schemas import schema

# Ethnicity code of non-indigenous people and the texts shown.
NOT_INDIGENOUS_CODE = "0000"
NOT_INDIGENOUS = "Não Indígena"
NOT_DECLARED = "Não Declarada"


def shaped(df: DataFrame, table: str) -> DataFrame:
    contract = schema(table)
    if "period" in df.columns:
        contract = contract.add("period", "string")
    return enforce_schema(df, contract, blanks_to_null=True)


def _version(df: DataFrame) -> DataFrame:
    key = snapshot_key("period_date", "unit_id", fallback="period")
    return df.withColumn("unit_version", key)


def units(silver: DataFrame) -> DataFrame:
    df = _version(silver).withColumn("place_id", pad_code("place_id", 6))
    return shaped(df.withColumn("unit_id", F.substring("unit_version", 7, 100)), "units")


def admissions(silver: DataFrame) -> DataFrame:
    df = _version(silver).withColumns(
        {
            "diagnosis": join_code_text("diagnosis_code", "diagnosis_text"),
            "ethnicity": replace_sentinel(
                "ethnicity", NOT_INDIGENOUS_CODE, NOT_INDIGENOUS, NOT_DECLARED
            ),
            "residence_place": pad_code("residence_place", 6),
            "care_place": pad_code("care_place", 6),
        }
    )
    return shaped(df, "admissions")


def beds(silver: DataFrame) -> DataFrame:
    """Bed lines; the id ends in the line's place in its month."""
    order = ["unit_version", "bed_kind", "place_id", "existing", "public_beds", "contracted"]
    numbered = row_sequence(_version(silver), "period", order, "_sequence")
    return shaped(numbered.withColumn("bed_id", F.concat("unit_version", "_sequence")), "beds")


def equipment(silver: DataFrame) -> DataFrame:
    """Equipment lines; the id is natural where kind and code are known.

    One staged order serves both numbers: the place in the month, which replaces
    missing parts, and the occurrence, which tells repeated natural ids apart.
    """
    df = _version(silver).withColumns(
        {"_kind": normalise_code("kind_code"), "_item": pad_code("item_code", 2)}
    )
    keys = ["period", "unit_version", "_kind", "_item"]
    ordered = stage_in_order(df, [*keys, "quantity", "in_use", "public_flag", "place_id"], once=True)
    ordered = add_position(ordered, ["period"], "_place")
    ordered = add_occurrence(ordered, keys, "_n", "_total")
    sequence = zero_fill(F.col("_place").cast("string"), 8)
    base = natural_or_artificial(
        [F.col("unit_version")], [F.col("_kind"), F.col("_item")], sequence
    )
    # Lines without natural parts have a place of their own and never repeat.
    natural = (F.coalesce("_kind", F.lit("")) != "") & (F.coalesce("_item", F.lit("")) != "")
    numbered = F.when(natural, occurrence_text(base, F.col("_n"), F.col("_total"))).otherwise(base)
    return shaped(
        ordered.withColumns(
            {
                "equipment_id": numbered,
                "equipment_kind": join_code_text("kind_code", "kind_text", "- "),
                "equipment_code": join_code_text("item_code", "item_text"),
                "place_id": pad_code("place_id", 6),
            }
        ),
        "equipment",
    )


def staff(silver: DataFrame) -> DataFrame:
    df = coalesce_columns(_version(silver), "person_id", ["person_id", "cns", "CNS"])
    return shaped(df.withColumn("occupation", clean_text("occupation")), "staff")


def licences(silver: DataFrame) -> DataFrame:
    return shaped(silver, "licences")


BUILDERS = {
    "units": units,
    "licences": licences,
    "staff": staff,
    "beds": beds,
    "equipment": equipment,
    "admissions": admissions,
}
# Unique key of each table, checked before it takes the place of the old one. A
# facility version and an admission come as their files have them: a repeated one is
# reported (``quality.pk_report``), not refused.
KEYS = {
    "licences": ["licence_id"],
    "staff": ["staff_id"],
    "beds": ["bed_id"],
    "equipment": ["equipment_id"],
    "places": ["place_id"],
    "dates": ["date"],
}
REPORTED_KEYS = {"units": ["unit_version"], "admissions": ["admission_id"]}
