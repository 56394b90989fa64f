"""Column expressions for textual codes. Codes stay text: leading zeros matter."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, functions as F

# Texts that stand for "no value" in source files.
MISSING_TEXTS = ["nan", "none", "<na>", "null"]
PLACEHOLDERS = ["", "None", "nan", "NaN", "0", "00", "NoneType", "<NA>"]
# Spellings of "yes" in flag columns.
YES_TEXTS = ["S", "SIM", "1", "Y", "YES", "TRUE"]


def _plain_forms() -> tuple[str, str, dict[str, str]]:
    """Characters with an ASCII compatibility decomposition: those of one letter as
    two strings for ``translate``, and the few longer ones of the Latin blocks."""
    one, plain, longer = [], [], {}
    for code in (*range(0xA0, 0x2200), *range(0xFB00, 0xFB07), *range(0xFF00, 0xFF60)):
        form = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if len(form) == 1:
            one.append(chr(code))
            plain.append(form)
        elif form and (code < 0x250 or code >= 0xFB00):
            longer[chr(code)] = form
    return "".join(one), "".join(plain), longer


ACCENTED, PLAIN, LONGER = _plain_forms()


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    return F.trim(as_col(c).cast("string"))


def blank_to_null(c: Column | str) -> Column:
    """Empty or all-blank text becomes NULL."""
    return F.nullif(clean_text(c), F.lit(""))


def normalise_code(c: Column | str) -> Column:
    """Trimmed text without the ``.0`` that a float read-in leaves behind."""
    text = clean_text(c)
    # Byte comparison and cut: several times cheaper per row than a pattern.
    return F.when(text.endswith(".0"), F.substring(text, F.lit(1), F.length(text) - 2)).otherwise(text)


def number_text(c: Column) -> Column:
    """A floating-point number in digits: ``12345678``, not ``1.2345678E7``."""
    whole = (F.abs(c) < 1e15) & (c == F.floor(c))
    digits = F.rtrim(c.try_cast("decimal(38,10)").cast("string"), F.lit("0"))
    return F.when(whole, c.cast("bigint").cast("string")).otherwise(digits)


def zero_fill(c: Column, width: int) -> Column:
    """Left-fill with zeros; longer text is kept whole (``lpad`` would cut it)."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def pad_digits(code: Column | str, width: int) -> Column:
    """``pad_code`` for text that is normalised already."""
    c = as_col(code)
    # Padded codes, most of them, are told by their length; a pattern costs several times as much.
    short = (F.length(c) < width) & c.rlike(f"^[0-9]{{1,{max(width - 1, 1)}}}$")
    return F.when(short, F.lpad(c, width, "0")).otherwise(c)


def pad_code(c: Column | str, width: int) -> Column:
    """Zero-fill all-digit codes to ``width``; other codes pass unchanged."""
    return pad_digits(normalise_code(c), width)


def strip_zeros(c: Column | str) -> Column:
    """Drop leading zeros of all-digit codes; an all-zero code becomes ``0``."""
    text = normalise_code(c)
    return F.when(text.startswith("0"), F.regexp_replace(text, r"^0+(?=[0-9]+$)", "")).otherwise(text)


def digits_only(c: Column | str) -> Column:
    """The digits of a text, without a float's trailing ``.0``."""
    return F.regexp_replace(as_col(c).cast("string"), r"\.0\s*$|[^0-9]", "")


def digits_code(c: Column | str, width: int) -> Column:
    """Only the digits of a code, zero-filled; NULL when there are none."""
    return zero_fill(F.nullif(digits_only(c), F.lit("")), width)


def catalog_code(c: Column | str) -> Column:
    """Upper-case code without dots, the form used by disease catalogs."""
    return F.replace(F.upper(clean_text(c)), F.lit("."), F.lit(""))


def present_text(c: Column | str) -> Column:
    """Trimmed text, NULL when blank or a spelled-out missing value."""
    text = blank_to_null(c)
    return F.when(~F.lower(text).isin(MISSING_TEXTS), text)


def join_code_text(code: Column | str, text: Column | str, sep: str = " - ") -> Column:
    """``code sep text``; whichever is present alone; NULL when neither is."""
    # concat_ws skips NULL arguments, which yields all three partial cases.
    return F.nullif(F.concat_ws(sep, present_text(code), present_text(text)), F.lit(""))


def is_yes(c: Column | str) -> Column:
    """True for the accepted spellings of a set flag; never NULL."""
    return F.coalesce(F.upper(clean_text(c)).isin(YES_TEXTS), F.lit(False))


def starts_with_any(c: Column | str, prefixes: list[str]) -> Column:
    """True when the code begins with one of the prefixes; False for NULL."""
    lengths = {len(p) for p in prefixes}
    if len(lengths) == 1:
        return F.coalesce(F.substring(as_col(c), 1, lengths.pop()).isin(prefixes), F.lit(False))
    pattern = "^(" + "|".join(re.escape(p) for p in prefixes) + ")"
    return F.coalesce(as_col(c).rlike(pattern), F.lit(False))


def is_placeholder(c: Column | str, tokens: list[str] = PLACEHOLDERS) -> Column:
    """True for NULL and for texts that only pretend to be a value."""
    code = normalise_code(c)
    return code.isNull() | code.isin(tokens)


def replace_sentinel(
    c: Column | str, sentinel: str, sentinel_text: str, null_text: str
) -> Column:
    """Spell out a sentinel code and the missing value."""
    text = clean_text(c)
    return F.coalesce(
        F.when(text == sentinel, F.lit(sentinel_text)).otherwise(text), F.lit(null_text)
    )


def unaccented(c: Column | str) -> Column:
    """The text in ASCII: letters without their accents, what has no plain form left out."""
    text = as_col(c)
    plain = F.translate(text, ACCENTED, PLAIN)
    for letter, form in LONGER.items():
        plain = F.replace(plain, F.lit(letter), F.lit(form))
    plain = F.regexp_replace(plain, r"[^\x00-\x7F]", "")
    return F.when(text.rlike(r"[^\x00-\x7F]"), plain).otherwise(text)


def slug(c: Column | str) -> Column:
    """Column form of :func:`header_slug`."""
    plain = F.lower(unaccented(clean_text(c)))
    return F.btrim(F.regexp_replace(plain, r"[^a-z0-9]+", "_"), F.lit("_"))


def header_slug(name: str) -> str:
    """A file header as an identifier: no accents, lower case, underscores."""
    plain = unicodedata.normalize("NFKD", str(name)).encode("ascii", "ignore").decode()
    return re.sub(r"[^a-z0-9]+", "_", plain.strip().lower()).strip("_")


def to_number(c: Column | str) -> Column:
    """A double, or NULL when the text is not a number."""
    text = clean_text(c)
    # The cast throws and catches inside: text that begins like no number, Infinity or NaN, is not given to it.
    return F.when(~text.rlike("^[A-HJ-MO-Za-hj-mo-z]"), text.try_cast("double"))


def to_amount(c: Column | str, digits: int = 1) -> Column:
    """A number rounded half to even."""
    return F.bround(to_number(c), digits)
