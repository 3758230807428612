"""Order-independent rounded sums and means.

``round(sum(double), 2)`` depends on the order in which partial sums are merged, so two
runs (or two engines) can disagree on a tie. Here each value is read as a whole number of
``10**-scale`` units (``scale`` = the places the data is recorded in, so the reading is exact),
the units are summed as bigint, and the result is rounded half away from zero with integer
arithmetic: ``sign(U) * ((2|U| + k n) div (2 k n))`` with ``k = 10**(scale - digits)``
(``n = 1`` for the sum). No intermediate value is ever rounded, and the sum is a plain long
sum, so the aggregate stays on the fast fixed-width path. NaN and an overflow (beyond 9.2e18
units in one group) are errors, with ANSI mode on or off. A value with more places than ``scale``
would be rounded when read, so the scale has no default; ``bin_columns`` and ``sum_of_bins`` add
doubles of any scale without regard to order. Results are
doubles, like the plain form; ``float_sum`` / ``float_avg`` give ``round(agg(double), d)``.

The expressions are SQL text over a column name so that the integer ``div`` operator is
available; they run JVM-side inside the aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def units(name: str, scale: int) -> str:
    """SQL: the value as a whole number of ``10**-scale`` units (bigint)."""
    x = f"{_q(name)} * {10 ** scale}D"
    # the same with ANSI mode on and off: what bigint cannot hold is an error, and so is NaN, which compares as the largest
    return (
        f"case when abs({x}) >= 9.2e18D then raise_error(concat('no exact sum of {name}: ', {_q(name)}))"
        f" else cast(rint({x}) as bigint) end"
    )


def _sum(name: str, scale: int) -> str:
    """SQL: the sum of the units; an overflow is an error in either mode."""
    total = f"try_sum({units(name, scale)})"
    return f"(case when {total} is null and count({_q(name)}) > 0 then raise_error('sum of {name} overflows') else {total} end)"


def _rounded(total: str, k_n: str, digits: int) -> str:
    q = f"((2 * abs({total}) + {k_n}) div (2 * {k_n}))"
    return f"(case when {total} < 0 then -{q} else {q} end) / {10 ** digits}D"


def exact_sum(name: str, scale: int, digits: int = 2) -> Column:
    """Sum of a column, exact, rounded half away from zero to ``digits`` places, as double."""
    if scale < digits:
        raise ValueError("scale must be >= digits")
    total = _sum(name, scale)
    return F.expr(_rounded(total, str(10 ** (scale - digits)), digits))


def exact_avg(name: str, scale: int, digits: int = 2) -> Column:
    """Mean of the non-NULL values, exact, rounded half away from zero, as double."""
    if scale < digits:
        raise ValueError("scale must be >= digits")
    total = _sum(name, scale)
    n = f"count({_q(name)})"
    k_n = f"{10 ** (scale - digits)} * {n}"
    return F.expr(f"case when {n} = 0 then cast(null as double) else {_rounded(total, k_n, digits)} end")


def unit_column(name: str, scale: int) -> Column:
    """A column as a whole number of ``10**-scale`` units, to be projected once and summed after."""
    return F.expr(units(name, scale))


def sum_of_units(total: str, count: str, scale: int, digits: int) -> Column:
    """The rounded sum from a column of summed units and one of counts."""
    checked = _checked(total, count)
    return F.expr(_rounded(checked, str(10 ** (scale - digits)), digits))


def avg_of_units(total: str, count: str, scale: int, digits: int) -> Column:
    """The rounded mean from a column of summed units and one of counts."""
    n = _q(count)
    return F.expr(f"case when {n} = 0 then cast(null as double) else {_rounded(_checked(total, count), f'{10 ** (scale - digits)} * {n}', digits)} end")


def _checked(total: str, count: str) -> str:
    return f"(case when {_q(total)} is null and {_q(count)} > 0 then raise_error('sum of {total} overflows') else {_q(total)} end)"


#: Exponents (in steps of 32 bits) of the bins of a sum without a declared scale: values are held to
#: multiples of 2**-96 (1e-29), and are below 2**63 (9e18).
BINS = range(-3, 2)


def finite_column(name: str) -> Column:
    """The value if it is finite; one too large for the bins is an error."""
    x = F.col(_q(name))
    error = F.raise_error(F.concat(F.lit(f"no exact sum of {name}: "), x.cast("string")))
    return F.when(F.abs(x) < 2.0**63, x).when(F.abs(x) < float("inf"), error)


def not_finite_column(name: str) -> Column:
    x = F.col(_q(name))
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), x)


def bin_columns(name: str, finite: str) -> dict[str, Column]:
    """What an order-free sum of doubles of any scale adds up: per bin a whole number of
    ``2**(32 k)`` of the column ``finite`` (``finite_column``, projected before).

    ``rint(x / 2**(32 k)) - 2**32 rint(x / 2**(32 (k + 1)))`` is exact in doubles (powers of two scale
    without rounding, and the difference is a whole number of at most 33 bits), so the bins of a value
    hold it whole, and long sums of them do not depend on any order."""
    x = F.col(_q(finite))
    at = lambda k: F.rint(x * 2.0 ** (-32 * k))
    out = {}
    for k in BINS:
        whole = at(k) - at(k + 1) * 2.0**32 if k + 1 in BINS else at(k)
        out[f"b{k - BINS.start}_{name}"] = whole.cast("long")
    return out


def sum_of_bins(name: str, count: str) -> Column:
    """The sum from the added-up bin columns: from the highest bin down, always in the same order."""
    total = None
    for k in reversed(BINS):
        b, n = F.col(_q(f"b{k - BINS.start}_{name}")), F.col(_q(count))
        whole = F.when(b.isNull() & F.col(_q(f"w_{name}")).isNull() & (n > 0), F.raise_error(F.lit(f"sum of {name} overflows"))).otherwise(b)
        part = whole.cast("double") * 2.0 ** (32 * k)
        total = part if total is None else total + part
    return F.coalesce(F.col(_q(f"w_{name}")), total)


def float_sum(name: str, digits: int = 2) -> Column:
    """The plain form: ``round(sum(col), digits)`` on doubles."""
    return F.round(F.sum(F.col(name)), digits)


def float_avg(name: str, digits: int = 2) -> Column:
    """The plain form: ``round(avg(col), digits)`` on doubles."""
    return F.round(F.avg(F.col(name)), digits)
