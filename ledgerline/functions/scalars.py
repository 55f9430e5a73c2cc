"""Scalar column expressions; all stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A reported duration is a quarter or a year when its day count lies in these.
QUARTER_DAYS = (80, 100)
YEAR_DAYS = (350, 380)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Ratio to two decimals, null for a null or zero denominator.

    Rounds the scaled double, not its decimal text: ``round(1.005, 2)`` is 1.0 here.
    """
    return F.round(_col(numerator) / F.nullif(_col(denominator), F.lit(0)) * 100) / 100


def days_between(start: Column | str, end: Column | str) -> Column:
    """Whole days from start to end; null when either is null."""
    return F.datediff(_col(end), _col(start))


def duration_class(
    days: Column | str, quarter: tuple[int, int] = QUARTER_DAYS, year: tuple[int, int] = YEAR_DAYS
) -> Column:
    """'quarter', 'year' or null; bounds are inclusive."""
    days = _col(days)
    return F.when(days.between(*quarter), "quarter").when(days.between(*year), "year")


def tolerant_double(text: Column | str) -> Column:
    """Number or null: unparsable text and NaN both give null."""
    number = _col(text).try_cast("double")
    return F.when(~F.isnan(number), number)


def nan_to_null(value: Column | str) -> Column:
    return F.when(~F.isnan(_col(value)), _col(value))


def either_zero(value: Column | str) -> Column:
    """The value, or 0 when it is null."""
    return F.coalesce(_col(value), F.lit(0))


def pct_change(current: Column | str, previous: Column | str) -> Column:
    """Percent change; null when the base is null or zero."""
    return (F.try_divide(_col(current), _col(previous)) - 1) * 100


def month_start(value: Column | str) -> Column:
    return F.trunc(_col(value), "MM")


def let(name: str, value: str, then: str) -> str:
    """SQL text of ``then`` in which ``name`` stands for ``value``, worked out once."""
    return f"element_at(transform(array({value}), {name} -> {then}), 1)"


def fixed_text(value: str, digits: str, signed: str) -> str:
    """SQL text of a number's fixed-point text; all three are SQL, so one expression can serve many numbers.

    The binary value is rounded exactly, ties to even: 0.125 gives 0.12 and 2.675, whose binary value lies
    below, 2.67. The fraction's product with the power of ten is taken in two parts whose sum is exact, so ties
    are told from values beside them. A negative value that rounds to zero keeps its sign; no number reads
    ``nan``, an infinite one ``inf``, null stays null.
    """
    odd = "if(f.d = 0, a.whole, c.kept) % 2 = 1"
    up = f"c.rest > 0.5D or (c.rest = 0.5D and (missing > 0D or (missing = 0D and {odd})))"
    behind = "if(f.d = 0, '', concat('.', lpad(cast(last % f.scale as string), f.d, '0')))"
    number = f"concat(cast(a.whole + if(last >= f.scale, 1, 0) as string), {behind})"
    # 2^27 + 1 parts the fraction's digits in an upper and a lower half.
    number = let("last", f"c.kept + if({up}, 1, 0)", number)
    number = let("missing", "(c.upper * f.scale - b.product) + (part - c.upper) * f.scale", number)
    parts = "named_struct('kept', floor(b.product), 'rest', b.product - floor(b.product), 'upper', b.split - (b.split - part))"
    number = let("c", parts, number)
    number = let("b", "named_struct('product', part * f.scale, 'split', part * 134217729D)", number)
    number = let("part", "a.size - a.whole", number)
    number = let("a", "named_struct('size', abs(f.v), 'whole', floor(abs(f.v)))", number)
    number = (
        f"case when isnan(f.v) then 'nan' when abs(f.v) = double('infinity') then 'inf' when abs(f.v) < 9e18D then {number}"
        f" else format_string(concat('%.', f.d, 'f'), abs(f.v)) end"  # whole numbers beyond a bigint
    )
    sign = f"if(startswith(cast(f.v as string), '-'), '-', if({signed}, '+', ''))"
    given = f"named_struct('v', cast({value} as double), 'd', {digits}, 'scale', cast(pow(10, {digits}) as bigint))"
    return let("f", given, f"if(f.v is null, null, concat({sign}, {number}))")


def signed_fixed(column: str, digits: int, signed: bool = False) -> Column:
    """Fixed-point text of a column, such as ``+1.25``; see ``fixed_text``."""
    return F.expr(fixed_text(f"`{column}`", str(digits), str(signed).lower()))


def iso_date(value: Column | str) -> Column:
    return F.date_format(_col(value), "yyyy-MM-dd")
