"""Fixed schemas of the star tables and of the load ledgers."""

from __future__ import annotations

from pyspark.sql import types as T


DATES = (
    "date date, month string, year string, day_of_year string, day_of_month string, "
    "week_of_month string, week_of_year string, weekday_name string, month_name string, "
    "two_month string, quarter string, half_year string"
)
PLACES = "place_id string, place_name string, region string, state string"
EQUIPMENT = (
    "equipment_id string, period_date date, quantity double, in_use double, "
    "public_flag string, place_id string, unit_version string, equipment_kind string, "
    "equipment_code string"
)
BEDS = (
    "bed_id string, period_date date, contracted double, public_beds double, "
    "existing double, bed_kind string, place_id string, unit_version string"
)
LICENCES = "licence_id bigint, licence string, issued_on date, unit_version string"
ADMISSIONS = (
    "admission_id string, diagnosis string, cost double, age double, sex string, "
    "icu_days double, admission_type string, race string, ethnicity string, "
    "icu_kind string, period_date date, entry_date date, exit_date date, "
    "residence_place string, care_place string, unit_version string"
)
UNITS = (
    "unit_version string, unit_id string, period_date date, unit_kind string, "
    "clientele string, place_id string"
)
STAFF = (
    "staff_id bigint, period_date date, hours double, public_link string, "
    "occupation string, registry string, place_id string, unit_version string, "
    "person_id string"
)
NAMES = "unit_id string, trade_name string, legal_name string"

FILE_LEDGER = (
    "table_name string, file_name string, tag string, row_count bigint, "
    "status string, loaded_at timestamp"
)
PERIOD_LEDGER = (
    "load_id string, table_name string, period string, content_hash string, "
    "row_count bigint, tag string, status string, loaded_at timestamp"
)
BUCKET_LEDGER = (
    "load_id string, table_name string, period string, bucket int, "
    "content_hash string, row_count bigint, loaded_at timestamp"
)

DDL = {
    "dates": DATES,
    "places": PLACES,
    "units": UNITS,
    "licences": LICENCES,
    "staff": STAFF,
    "beds": BEDS,
    "equipment": EQUIPMENT,
    "admissions": ADMISSIONS,
    "names": NAMES,
    "bucket_ledger": BUCKET_LEDGER,
    "file_ledger": FILE_LEDGER,
    "period_ledger": PERIOD_LEDGER,
}


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(DDL[table])


# Column names under which existing star tables are stored, per
# table, and the names used here. ``rename_aliases`` applies them on read.
STORED_NAMES = {
    "dates": {
        "data": "date", "mes": "month", "ano": "year", "dia_ano": "day_of_year",
        "dia_mes": "day_of_month", "semana_mes": "week_of_month",
        "semana_ano": "week_of_year", "dia_semana_nome": "weekday_name",
        "mes_nome": "month_name", "bimestre": "two_month",
        "trimestre": "quarter", "semestre": "half_year",
    },
    "places": {
        "id_municipio": "place_id", "nome_municipio": "place_name",
        "regiao": "region", "uf": "state",
    },
    "units": {
        "id_versao_unidade": "unit_version", "id_unidade_saude": "unit_id",
        "dim_data_data": "period_date", "tipo_unidade": "unit_kind",
        "clientela": "clientele", "dim_municipio_id_municipio": "place_id",
    },
    "licences": {
        "id_alvara": "licence_id", "alvara": "licence", "data_emissao": "issued_on",
        "unidade_saude_id_unidade_ver": "unit_version",
        "unidae_saude_id_unidade_ver": "unit_version",
    },
    "staff": {
        "id_profissional": "staff_id", "dim_data_data": "period_date",
        "horas_trabalhadas": "hours", "vinculo_sus": "public_link",
        "cbo": "occupation", "registro": "registry",
        "dim_municipio_id_municipio": "place_id",
        "unidade_saude_id_unidade_ver": "unit_version", "cns": "person_id",
    },
    "beds": {
        "id_leitos": "bed_id", "dim_data_data": "period_date",
        "qt_contratada": "contracted", "disponivel_sus": "public_beds",
        "qt_existente": "existing", "tipo_leito": "bed_kind",
        "dim_municipio_id_municipio": "place_id",
        "unidade_saude_id_unidade_ver": "unit_version",
    },
    "equipment": {
        "id_equipamento": "equipment_id", "dim_data_data": "period_date",
        "qt_equipamentos": "quantity", "qt_uso": "in_use",
        "disponibilidade_sus": "public_flag",
        "dim_municipio_id_municipio": "place_id",
        "unidade_saude_id_unidade_ver": "unit_version",
        "tipo_equipamento": "equipment_kind", "codigo_equipamento": "equipment_code",
    },
    "admissions": {
        "id_internacao": "admission_id", "diagnostico": "diagnosis",
        "valor_internacao": "cost", "idade": "age", "sexo": "sex",
        "dias_uti": "icu_days", "carater_internacao": "admission_type",
        "raca_cor": "race", "etnia": "ethnicity", "tipo_uti": "icu_kind",
        "dim_data_data_competencia": "period_date",
        "dim_data_data_entrada": "entry_date", "dim_data_data_saida": "exit_date",
        "dim_municipio_municipio_res": "residence_place",
        "dim_municipio_municipio_int": "care_place",
        "unidade_saude_id_unidade": "unit_version",
    },
    "names": {
        "id_unidade_saude": "unit_id", "nome_fantasia": "trade_name",
        "razao_social": "legal_name",
    },
}
