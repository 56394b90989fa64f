"""Code catalogs and translations.

Lookups are frames joined on equality. No side is broadcast by hint: Spark
broadcasts a lookup whose measured size allows it and shuffles a larger one,
splitting hot codes (see ``snapmart.session``).
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapmart.functions.codes import blank_to_null, catalog_code, clean_text, normalise_code
from snapmart.operators.aggregate import latest_per_key, top_k_per_group
from snapmart.operators.shape import slug_headers

# Header names under which occupation catalogs publish their columns.
CODE_HEADERS = ["codigo", "codigo_cbo", "cbo", "cod_ocupacao", "codigo_ocupacao"]
TITLE_HEADERS = ["titulo", "titulo_ocupacao", "descricao", "descricao_ocupacao", "nome"]


def resolve_header(columns: list[str], candidates: list[str], hints: list[list[str]]) -> str:
    """The first candidate present, else the first column holding every word of
    one of the hints."""
    for c in candidates:
        if c in columns:
            return c
    for c in columns:
        if any(all(word in c for word in hint) for hint in hints):
            return c
    raise ValueError(f"no column like {candidates} among {columns}")


def first_per_code(df: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """(code, text) with one text per code: the first in ``order``, by default the
    alphabetically first, since a distributed read has no file order."""
    return latest_per_key(df, ["code"], order or [F.col("text")]).select("code", "text")


def load_catalog(
    df: DataFrame,
    code_candidates: list[str],
    text_candidates: list[str],
    clean=catalog_code,
    code_hints: list[list[str]] = (),
    text_hints: list[list[str]] = (),
    order: list[Column] | None = None,
) -> DataFrame:
    """A raw catalog frame as (code, text): headers resolved, codes cleaned,
    blanks dropped, one text per code."""
    df = slug_headers(df.drop(*[c for c in df.columns if not c.strip() or c.startswith("_c")]))
    code = resolve_header(df.columns, code_candidates, list(code_hints))
    text = resolve_header(df.columns, text_candidates, list(text_hints))
    if code == text:
        raise ValueError(f"one column, {code}, would be both code and text; wrong separator?")
    rows = df.withColumns({"code": F.nullif(clean(code), F.lit("")), "text": blank_to_null(text)})
    return first_per_code(rows.where(F.col("code").isNotNull() & F.col("text").isNotNull()), order)


def code_and_name(df: DataFrame, code: str, name: str, code_length: int | None = None) -> DataFrame:
    """(code, text) from an id and a name column, the id cut to its first digits."""
    text_code = F.col(code).cast("string")
    if code_length:
        text_code = F.substring(text_code, 1, code_length)
    return first_per_code(df.select(text_code.alias("code"), clean_text(name).alias("text")))


def add_description(
    df: DataFrame, code: Column | str, lookup: DataFrame, name: str
) -> DataFrame:
    """Add the catalog text of a code as a column, NULL when unknown."""
    return _match(df, [code], lookup, ["code"], name)


def add_description_by_pair(
    df: DataFrame, first: Column | str, second: Column | str, lookup: DataFrame, name: str
) -> DataFrame:
    """The same for a two-part code; ``lookup`` is (group, code, text)."""
    return _match(df, [first, second], lookup, ["group", "code"], name)


def translate_code(df: DataFrame, column: str, code: Column, lookup: DataFrame) -> DataFrame:
    """Replace a code by its text; unknown codes stay as they are."""
    known = _match(df.withColumn(column, code), [column], lookup, ["code"], "_text")
    return known.withColumn(column, F.coalesce("_text", column)).drop("_text")


def translate_inline(
    df: DataFrame, column: str, code: Column, lookup: DataFrame, sep: str = " - "
) -> DataFrame:
    """Replace a code by ``code sep text``; unknown codes stay alone."""
    known = _match(df.withColumn(column, code), [column], lookup, ["code"], "_text")
    joined = F.when(F.col(column).isNotNull(), F.concat_ws(sep, F.col(column), F.col("_text")))
    return known.withColumn(column, joined).drop("_text")


def from_prefix(
    df: DataFrame, code: str, prefixes: DataFrame, values: dict[str, str], length: int = 2
) -> DataFrame:
    """Add columns looked up by the first characters of a code; ``values`` gives
    each wanted column of ``prefixes`` (code, ...) and its default. Of a prefix
    listed more than once, the first row in the order of its values counts."""
    names = list(values)
    prefixes = latest_per_key(prefixes, ["code"], [F.col(n).asc_nulls_last() for n in names])
    wide = prefixes.select(F.col("code").alias("_prefix"), *[F.col(n).alias(f"_{n}") for n in names])
    joined = df.join(wide, F.substring(F.col(code), 1, length) == F.col("_prefix"), "left")
    return joined.withColumns(
        {n: F.coalesce(F.col(f"_{n}"), F.lit(d)) for n, d in values.items()}
    ).drop("_prefix", *[f"_{n}" for n in names])


def unmatched_profile(
    df: DataFrame,
    checks: dict[str, tuple[list[Column], DataFrame, list[str]]],
    examples: int = 10,
    weight: str | None = None,
) -> DataFrame:
    """(column, unmatched_rows, unmatched_codes, examples) per checked column.

    A check is (code parts, lookup, lookup keys). Codes are counted before the
    lookup is consulted, and only the first ``examples`` codes are ever gathered. ``weight``
    names the column that says for how many rows a line stands.
    """
    parts, number = [], F.count("*") if weight is None else F.sum("_weight")
    for name, (code_parts, lookup, keys) in checks.items():
        aliased = [c.alias(f"_k{i}") for i, c in enumerate(code_parts)]
        weights = [] if weight is None else [F.col(weight).alias("_weight")]
        codes = df.select(*aliased, *weights).groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(
            number.alias("_n")
        )
        known = lookup.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
        present = reduce(
            lambda a, b: a & b, [F.col(f"_k{i}").isNotNull() for i in range(len(keys))]
        )
        unknown = codes.where(present).join(known, [f"_k{i}" for i in range(len(keys))], "left_anti")
        shown = F.concat_ws("/", *[F.col(f"_k{i}") for i in range(len(keys))])
        parts.append(unknown.select(F.lit(name).alias("column"), shown.alias("_code"), "_n"))
    unknown = reduce(DataFrame.unionByName, parts)
    totals = unknown.groupBy("column").agg(
        F.sum("_n").alias("unmatched_rows"), F.count("*").alias("unmatched_codes")
    )
    shown = (
        top_k_per_group(unknown, ["column"], [F.col("_code")], examples)
        .groupBy("column")
        .agg(F.array_sort(F.collect_list("_code")).alias("examples"))
    )
    return totals.join(shown, "column")


def _match(
    df: DataFrame, parts: list[Column | str], lookup: DataFrame, keys: list[str], name: str
) -> DataFrame:
    """Left join on the code parts. Of a key listed more than once, the alphabetically first
    text counts, so a lookup never multiplies rows."""
    known = lookup.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min("text").alias(name))
    condition = reduce(
        lambda a, b: a & b,
        [
            (F.col(p) if isinstance(p, str) else p) == F.col(f"_k{i}")
            for i, p in enumerate(parts)
        ],
    )
    return df.join(known, condition, "left").drop(*[f"_k{i}" for i in range(len(keys))])


def lookup_from(spark: SparkSession, mapping: dict) -> DataFrame:
    """A small in-memory mapping as a lookup frame; pair keys give (group, code, text).

    Built from an Arrow table, so that Spark knows its size and broadcasts it.
    """
    rows = [(*k, v) if isinstance(k, tuple) else (k, v) for k, v in mapping.items()]
    names = ["group", "code", "text"] if rows and len(rows[0]) == 3 else ["code", "text"]
    columns = zip(*rows) if rows else ([] for _ in names)
    text = pa.schema([(n, pa.string()) for n in names])
    return spark.createDataFrame(pa.table([list(c) for c in columns], schema=text))


def normalised_lookup(df: DataFrame, code: str, text: str) -> DataFrame:
    """(code, text) with codes normalised, one text per code."""
    return first_per_code(df.select(normalise_code(code).alias("code"), clean_text(text).alias("text")))
