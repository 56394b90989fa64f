"""Catalog files: delimited text and JSON lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapmart.functions.codes import digits_code
from snapmart.operators.lookup import CODE_HEADERS, TITLE_HEADERS, code_and_name, load_catalog


# Words of the headers of occupation catalogs with other names.
CODE_HINTS = [["cod", "ocup"], ["cod", "cbo"]]
TITLE_HINTS = [["titul"], ["descr"]]


def read_delimited(
    spark: SparkSession, path: str, sep: str = ";", encoding: str = "ISO-8859-1"
) -> DataFrame:
    """A delimited file with a header, every column text."""
    return spark.read.csv(path, sep=sep, encoding=encoding, header=True, inferSchema=False)


def disease_catalog(spark: SparkSession, path: str, order: list[Column] | None = None) -> DataFrame:
    """(code, text) from the ``;``-separated disease catalog."""
    raw = read_delimited(spark, path)
    return load_catalog(raw, ["subcat"], ["descricao"], order=order)


def occupation_catalog(
    spark: SparkSession, path: str, separators: tuple[str, ...] = (";", ","), encoding: str = "ISO-8859-1"
) -> DataFrame:
    """(code, text) from an occupation catalog whose headers vary.

    The separator is the first under which both columns can be found.
    """
    problem: Exception | None = None
    for sep in separators:
        try:
            return load_catalog(
                read_delimited(spark, path, sep, encoding),
                CODE_HEADERS,
                TITLE_HEADERS,
                clean=lambda c: digits_code(c, 6),
                code_hints=CODE_HINTS,
                text_hints=TITLE_HINTS,
            )
        except ValueError as e:
            problem = e
    raise problem


def place_names(spark: SparkSession, path: str) -> DataFrame:
    """(6-digit code, name) from a JSON list of municipalities (id, nome)."""
    rows = spark.read.schema("id long, nome string").json(path, multiLine=True)
    return code_and_name(rows, "id", "nome", 6)


def json_members(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Rows of a JSON text column parsed into its fields."""
    return df.select(F.from_json(F.col(column), schema).alias("j")).select("j.*")
