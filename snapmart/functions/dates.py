"""Column expressions for dates and ``YYYYMM`` periods.

``as_of`` is always an argument, never the wall clock, so a job gives the same
answer when it is run again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from snapmart.functions.codes import as_col, digits_only, normalise_code, pad_code

# The span of plausible dates.
DATE_MIN = dt.date(1910, 1, 1)
DATE_MAX = dt.date(2028, 12, 31)
# Names used by the date dimension, Monday and January first.
WEEKDAY_NAMES = [
    "Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira",
    "Sexta-feira", "Sábado", "Domingo",
]
MONTH_NAMES = [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho", "Julho",
    "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]


# ---- plain-Python helpers for parameters -----------------------------------

def parse_month(text: str) -> dt.date:
    """First day of a ``YYYY-MM`` month; ``ValueError`` for anything else."""
    if len(text) != 7:
        raise ValueError(f"month must look like YYYY-MM: {text!r}")
    return dt.datetime.strptime(text, "%Y-%m").date()


def check_range(start: dt.date, end: dt.date) -> tuple[dt.date, dt.date]:
    if end < start:
        raise ValueError(f"range ends ({end}) before it starts ({start})")
    return start, end


def check_month_range(start: str, end: str) -> tuple[dt.date, dt.date]:
    return check_range(parse_month(start), parse_month(end))


def month_start(d: dt.date) -> dt.date:
    return d.replace(day=1)


def shift_months(d: dt.date, n: int) -> dt.date:
    """First day of the month ``n`` months after the month of ``d``."""
    years, month0 = divmod(d.year * 12 + d.month - 1 + n, 12)
    return dt.date(years, month0 + 1, 1)


def last_complete_periods(as_of: dt.date, n: int) -> list[str]:
    """The ``n`` whole months before the month of ``as_of``, oldest first."""
    return [shift_months(as_of, -k).strftime("%Y%m") for k in range(n, 0, -1)]


def retention_limit(as_of: dt.date, months: int) -> dt.date:
    """First month that retention keeps."""
    return shift_months(as_of, -months)


def year_to_date(as_of: dt.date) -> tuple[dt.date, dt.date]:
    return dt.date(as_of.year, 1, 1), as_of


# ---- predicates: bounds are literals, the column stays bare ----------------

def day_range(c: Column | str, start: dt.date, end: dt.date) -> Column:
    """Whole days ``start..end`` inclusive, also for columns with a time part."""
    check_range(start, end)
    d = as_col(c)
    return (d >= F.lit(start)) & (d < F.lit(end + dt.timedelta(days=1)))


def month_range(c: Column | str, start: dt.date, end: dt.date) -> Column:
    """Whole months from that of ``start`` to that of ``end`` inclusive."""
    check_range(start, end)
    d = as_col(c)
    return (d >= F.lit(month_start(start))) & (d < F.lit(shift_months(end, 1)))


def in_month(c: Column | str, month: dt.date) -> Column:
    return month_range(c, month, month)


def same_period(c: Column | str, period: Column | str) -> Column:
    """True when the date falls in the ``YYYYMM`` period; NULL dates drop out."""
    # Wrapped, so that no separate NOT NULL test repeats the parsing per row.
    return F.coalesce(F.trunc(as_col(c), "MM") == period_start(period), F.lit(False))


def names_period(text: Column | str, period: Column | str) -> Column:
    """``same_period`` of parsed ``YYYYMM`` or ``MMYYYY`` text.

    Text that is the period as it stands, either way round, is told by comparison.
    """
    c, p = as_col(text).cast("string"), as_col(period)
    turned = F.concat(F.substring(p, 5, 2), F.substring(p, 1, 4))
    return F.when(_plain(p) & ((c == p) | (c == turned)), F.lit(True)).otherwise(same_period(parse_period(c), p))


def year_month_names_period(year: Column | str, month: Column | str, period: Column | str) -> Column:
    """``same_period`` of separate year and month texts, told by comparison where they are digits only."""
    y, m, p = as_col(year).cast("string"), as_col(month).cast("string"), as_col(period)
    month_part = F.substring(p, 5, 2)
    plain = _plain(p) & (y == F.substring(p, 1, 4)) & ((m == month_part) | (F.concat(F.lit("0"), m) == month_part))
    return F.when(plain, F.lit(True)).otherwise(same_period(year_month_date(y, m), p))


def _plain(period: Column) -> Column:
    """True for six digits, a year that no month begins (see ``parse_period``) and a month."""
    return period.rlike("^(1[3-9]|[2-9][0-9])[0-9]{2}(0[1-9]|1[0-2])$")


# ---- values -----------------------------------------------------------------

def bounded(c: Column | str, lo: dt.date = DATE_MIN, hi: dt.date = DATE_MAX) -> Column:
    """The date, or NULL when it is implausible."""
    d = as_col(c)
    return F.when(d.between(F.lit(lo), F.lit(hi)), d)


def is_outlier(c: Column | str, lo: dt.date = DATE_MIN, hi: dt.date = DATE_MAX) -> Column:
    """True for a present date outside the plausible span."""
    return F.coalesce(~as_col(c).between(F.lit(lo), F.lit(hi)), F.lit(False))


# The parsers below mention their argument once. Spark copies an expression for every
# mention when it pushes a filter on the parsed date towards the scan, and chained
# mentions multiply. ISO text is cast, not formatted: the cast is a hand-written
# parser that answers NULL where a formatter would throw and catch.

def parse_ymd(c: Column | str) -> Column:
    """Strict ``YYYYMMDD`` text as a date, else NULL."""
    pattern = r"(?s)^(?:\s*([0-9]{4})([0-9]{2})([0-9]{2})(?:\.0)?\s*|.*)$"
    return F.regexp_replace(as_col(c).cast("string"), pattern, "$1-$2-$3").try_cast("date")


def parse_period(c: Column | str) -> Column:
    """``YYYYMM`` or ``MMYYYY`` text as the first day of that month.

    Text that starts with a month is read month first: ``092010`` is September
    2010. Year first it would be a year before 1300, which no date here can be.
    """
    pattern = r"^(?:(0[1-9]|1[0-2])([0-9]{4})|([0-9]{4})([0-9]{2})|.*)$"
    return F.regexp_replace(digits_only(c), pattern, "$2$3-$1$4-01").try_cast("date")


def year_month_date(year: Column | str, month: Column | str) -> Column:
    """Separate year and month texts as the first day of that month."""
    joined = F.concat_ws("-", as_col(year).cast("string"), as_col(month).cast("string"))
    pattern = r"^(?:\s*([0-9]{4})(?:\.0)?\s*-\s*(0?[1-9]|1[0-2])(?:\.0)?\s*|.*)$"
    return F.regexp_replace(joined, pattern, "$1-$2-01").try_cast("date")


def period_start(period: Column | str) -> Column:
    """First day of a ``YYYYMM`` period."""
    p = as_col(period)
    plain = F.concat_ws("-", F.substring(p, 1, 4), F.substring(p, 5, 2), F.lit("01"))
    return F.when(_plain(p), plain).otherwise(F.regexp_replace(p, r"^([0-9]{4})([0-9]{2})$", "$1-$2-01")).try_cast("date")


def period_key(c: Column | str) -> Column:
    """``YYYYMM`` of a date, by arithmetic: a formatter costs ten times as much."""
    d = as_col(c)
    return F.lpad((F.year(d) * 100 + F.month(d)).cast("string"), 6, "0")


def month_label(c: Column | str) -> Column:
    return F.date_format(as_col(c), "yyyy-MM")


def month_of(c: Column | str) -> Column:
    """First day of the month: the cheap key to group rows by before labelling."""
    return F.trunc(as_col(c), "MM")


def snapshot_key(
    date: Column | str,
    code: Column | str,
    width: int = 7,
    fallback: Column | str | None = None,
) -> Column:
    """Period followed by the padded code; ``fallback`` period for NULL dates."""
    period = period_key(date)
    if fallback is not None:
        period = F.coalesce(period, as_col(fallback))
    return F.concat(period, pad_code(code, width))


def key_period(c: Column | str) -> Column:
    """The period at the front of a snapshot key, NULL when it is not six digits."""
    head = F.substring(normalise_code(c), 1, 6)
    return F.when(head.rlike(r"^[0-9]{6}$"), head)


def is_period(c: Column | str) -> Column:
    """True for ``YYYYMM`` with a year from 1900 on and a month 01 to 12."""
    return F.coalesce(
        as_col(c).rlike(r"^(19|[2-9][0-9])[0-9]{2}(0[1-9]|1[0-2])$"), F.lit(False)
    )


def stay_days(entry: Column | str, leave: Column | str) -> Column:
    """Days between two dates, NULL when either is missing."""
    return F.datediff(as_col(leave), as_col(entry))


def calendar_columns(
    c: Column | str,
    weekday_names: list[str] = WEEKDAY_NAMES,
    month_names: list[str] = MONTH_NAMES,
) -> dict[str, Column]:
    """Attributes of the date dimension, all text."""
    d = as_col(c)
    names = lambda values: F.array(*[F.lit(v) for v in values])
    part = lambda n: F.floor((F.month(d) - 1) / F.lit(n) + 1).cast("string")
    return {
        "month": F.date_format(d, "MM"),
        "year": F.date_format(d, "yyyy"),
        "day_of_year": F.dayofyear(d).cast("string"),
        "day_of_month": F.dayofmonth(d).cast("string"),
        "week_of_month": F.floor((F.dayofmonth(d) - 1) / F.lit(7) + 1).cast("string"),
        "week_of_year": F.weekofyear(d).cast("string"),
        "weekday_name": F.element_at(names(weekday_names), F.weekday(d) + 1),
        "month_name": F.element_at(names(month_names), F.month(d)),
        "two_month": part(2),
        "quarter": F.quarter(d).cast("string"),
        "half_year": part(6),
    }
