"""Money expressions, written as SQL text so that the DataFrame and the SQL paths share them.

Sums are exact. DECIMAL money adds up as it is. DOUBLE money goes through an
accumulator by exponent range: an amount is cut into integer limbs of 24 bits
(its bits from 2**-96 to 2**119), each limb is summed as BIGINT, and the limbs
are carried once at the end into the double nearest to the exact sum. So a sum
does not depend on the order of its rows or on how partial sums are merged,
and tiny, huge and cancelling amounts all count. A group with an amount that
has no such limbs (NaN, infinite, at least 2**119, or with bits below 2**-96)
gets the plain DOUBLE sum. The public output is rounded and DOUBLE last.

A sum's state (limb sums, number of amounts without limbs, plain sum) can be
stored and merged: see ``money_state`` and ``state_merge``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType

from salesmart.schemas import MONEY

LIMB_BITS = 24
LIMBS = 9
LOWEST_BIT = -96
HIGHEST_BIT = LOWEST_BIT + LIMB_BITS * LIMBS - 1


def money(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(MONEY)


def zero_of(df: DataFrame, column: str) -> Column:
    """A zero literal typed like ``df[column]`` (DECIMAL stays DECIMAL)."""
    data_type: DataType = df.schema[column].dataType
    return F.lit(0).cast(data_type)


def is_exact(df: DataFrame, column: str) -> bool:
    """Whether the column adds up exactly as it is (DECIMAL and integers)."""
    return not isinstance(df.schema[column].dataType, (DoubleType, FloatType))


# --- limbs of a DOUBLE


def _double(value: float) -> str:
    return f"{value!r}D".upper()


def _has_limbs(x: str) -> str:
    low = _double(2.0**-LOWEST_BIT)
    return f"(abs({x}) < {_double(2.0**HIGHEST_BIT)} AND rint({x} * {low}) = {x} * {low})"


def _beyond(x: str) -> str:
    return f"count_if({x} IS NOT NULL AND NOT {_has_limbs(x)})"


def _limb_sums(x: str) -> str:
    """An array of BIGINT sums: limb k counts 2 ** (LOWEST_BIT + 24 k)."""

    def rounded(k: int) -> str:
        return f"rint({x} * {_double(2.0 ** (-LOWEST_BIT - LIMB_BITS * k))})"

    def limb(k: int) -> str:
        # what rounding to the next higher limb leaves; exact, as it is a small integer
        if k == LIMBS - 1:
            return rounded(k)
        return f"{rounded(k)} - {rounded(k + 1)} * {_double(2.0**LIMB_BITS)}"

    sums = [f"sum(CASE WHEN {_has_limbs(x)} THEN CAST({limb(k)} AS BIGINT) END)" for k in range(LIMBS)]
    return f"array({', '.join(sums)})"


def _carried(limbs: str) -> str:
    """Limb sums as digits 0 .. 2**24 - 1, lowest first, then two digits of the (signed) rest."""
    mask = 2**LIMB_BITS - 1
    step = (
        f"(s, v) -> named_struct('rest', shiftright(s.rest + v, {LIMB_BITS}), "
        f"'digits', concat(s.digits, array((s.rest + v) & {mask}L)))"
    )
    start = "named_struct('rest', 0L, 'digits', CAST(array() AS ARRAY<BIGINT>))"
    finish = f"s -> concat(s.digits, array(s.rest & {mask}L, shiftright(s.rest, {LIMB_BITS})))"
    return f"aggregate({limbs}, {start}, {step}, {finish})"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


#: Limbs of common amounts: the first and the last that the short way takes, and the last one's bound.
SHORT_LOW, SHORT_HIGH = 1, 5
SHORT_LIMIT = 2**27


def nearest_double(limbs: str) -> str:
    """The double nearest to the number that limb sums stand for; NULL without amounts.

    Sums of common amounts (bits from 2**-72 on, below 2**51) are one DECIMAL integer.
    """
    others = [f"{limbs}[{k}] = 0" for k in range(LIMBS) if not SHORT_LOW <= k <= SHORT_HIGH]
    small = [f"abs({limbs}[{k}]) < {2**50}" for k in range(SHORT_LOW, SHORT_HIGH)]
    short = " AND ".join([*others, *small, f"abs({limbs}[{SHORT_HIGH}]) < {SHORT_LIMIT}"])
    parts = []
    for k in range(SHORT_LOW, SHORT_HIGH + 1):
        unit = 2 ** (LIMB_BITS * (k - SHORT_LOW))
        width = 9 if k == SHORT_HIGH else 16
        term = f"CAST({limbs}[{k}] AS DECIMAL({width},0)) * CAST({unit}BD AS DECIMAL({len(str(unit))},0))"
        parts.append(f"CAST({term} AS DECIMAL(38,0))")
    total = parts[0]
    for part in parts[1:]:
        total = f"CAST({total} + {part} AS DECIMAL(38,0))"
    scale = _double(2.0 ** (LOWEST_BIT + LIMB_BITS * SHORT_LOW))
    return (
        f"CASE WHEN {limbs}[0] IS NOT NULL THEN "
        f"CASE WHEN {short} THEN CAST({total} AS DOUBLE) * {scale} ELSE {_nearest_of_all(limbs)} END END"
    )


def _nearest_of_all(limbs: str) -> str:
    """``nearest_double`` for any limb sums: carried into digits, sign and magnitude apart.

    The four highest digits and a mark for anything below them hold more bits
    than a double, so that one rounding, of a DECIMAL to DOUBLE, is all.
    """
    digits = LIMBS + 2
    low = "CAST(array(0, 0, 0) AS ARRAY<BIGINT>)"  # below the lowest, so that four digits always exist
    top = "array_position(transform(reverse(d), x -> x <> 0), true)"  # from the highest, 0: none

    def digit(k: int) -> str:
        return f"d[p - {k}]"

    base = 2**LIMB_BITS
    high_part = f"CAST({digit(0)} * {base} + {digit(1)} AS DECIMAL(15,0))"
    low_part = f"CAST({digit(2)} * {base} + {digit(3)} AS DECIMAL(15,0))"
    four = f"({high_part} * CAST({base**2} AS DECIMAL(15,0)) + {low_part})"
    rest = "CAST(int(exists(slice(d, 1, p - 3), x -> x <> 0)) AS DECIMAL(1,0))"
    scale = f"pow(2D, {LIMB_BITS}D * (p - 6) + {LOWEST_BIT - 1}D)"
    value = f"CAST({four} * CAST(2 AS DECIMAL(1,0)) + {rest} AS DOUBLE) * {scale}"
    magnitude = _let("p", f"int({digits + 3} - {top})", f"CASE WHEN {top} = 0 THEN 0D ELSE {value} END")
    signed = _let(
        "n",
        _let("c", _carried(limbs), f"c[{digits - 1}] < 0"),
        _let(
            "d",
            f"concat({low}, {_carried(f'transform({limbs}, v -> CASE WHEN n THEN -v ELSE v END)')})",
            f"CASE WHEN n THEN -({magnitude}) ELSE {magnitude} END",
        ),
    )
    return signed


# --- rounded sums and means, as SQL text

#: Up to here a sum has a DECIMAL of its shortest text, in which a mean is divided exactly.
MEAN_LIMIT = 1e28


def sum_sql(column: str, exact: bool) -> str:
    """ROUND(SUM(column), 2) as DOUBLE; ``exact``: the column is DECIMAL."""
    x = f"`{column}`"
    if exact:
        return f"CAST(ROUND(SUM({x}), 2) AS DOUBLE)"
    return _state_sum(_let("limbs", _limb_sums(x), nearest_double("limbs")), _beyond(x), f"SUM({x})")


def mean_sql(column: str, count: str) -> str:
    """ROUND(SUM(column) / count, 2) of a DOUBLE column as DOUBLE; 0 for a count of 0."""
    x = f"`{column}`"
    nearest = _let("limbs", _limb_sums(x), nearest_double("limbs"))
    return _state_mean(nearest, _beyond(x), f"SUM({x})", count)


def _state_sum(nearest: str, beyond: str, plain: str) -> str:
    return f"ROUND(CASE WHEN {beyond} > 0 THEN {plain} ELSE {nearest} END, 2)"


def _state_mean(nearest: str, beyond: str, plain: str, count: str) -> str:
    divided = (
        f"CASE WHEN abs(t) < {_double(MEAN_LIMIT)} "
        f"THEN CAST(ROUND(CAST(t AS DECIMAL(38,8)) / {count}, 2) AS DOUBLE) ELSE ROUND(t / {count}, 2) END"
    )
    total = f"CASE WHEN {beyond} > 0 THEN {plain} ELSE {nearest} END"
    return f"CASE WHEN {count} = 0 THEN 0D ELSE {_let('t', total, divided)} END"


def rounded_sum(df: DataFrame, column: str) -> Column:
    """ROUND(SUM(x), 2) as DOUBLE; see the module docstring for DOUBLE columns."""
    return F.expr(sum_sql(column, is_exact(df, column)))


def rounded_mean(df: DataFrame, column: str, count: Column) -> Column:
    """ROUND(SUM(x) / count, 2) of a DOUBLE column, the sum as in ``rounded_sum``; 0 for no rows."""
    x = f"`{column}`"
    nearest = _let("limbs", _limb_sums(x), nearest_double("limbs"))
    total = F.expr(f"CASE WHEN {_beyond(x)} > 0 THEN SUM({x}) ELSE {nearest} END")

    def mean(p: Column) -> Column:
        exact = F.round(p["t"].cast("decimal(38,8)") / p["n"], 2).cast("double")
        divided = F.when(F.abs(p["t"]) < MEAN_LIMIT, exact).otherwise(F.round(p["t"] / p["n"], 2))
        return F.when(p["n"] == 0, F.lit(0.0)).otherwise(divided)

    return F.get(F.transform(F.array(F.struct(total.alias("t"), count.alias("n"))), mean), F.lit(0))


def cents(col: Column | str) -> Column:
    """A money amount as integer cents (exact for DECIMAL input)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c * F.lit(100), 0).cast("long")


def half_up_ratio(cents_column: str, count_column: str) -> Column:
    """ROUND(cents / 100 / count, 2) half-up as DOUBLE, 0 when count is 0.

    Both arguments name long columns. The division is the SQL integer
    ``div``, so no intermediate rounding can move a result by one cent.
    """
    n, c = count_column, cents_column
    return F.expr(
        f"CASE WHEN {n} = 0 THEN CAST(0 AS DOUBLE) "
        f"ELSE CAST((2 * {c} + {n}) div (2 * {n}) AS DOUBLE) / 100 END"
    )


# --- the same sums as stored, mergeable state


@dataclass(frozen=True)
class StateColumns:
    """Columns of a measure's state: its sum (DECIMAL, or limb sums), amounts without limbs, plain sum."""

    total: str
    beyond: str
    plain: str


def state_columns(measure: str) -> StateColumns:
    return StateColumns(f"{measure}_total", f"{measure}_beyond", f"{measure}_plain")


def money_state(df: DataFrame, measure: str) -> list[Column]:
    """Aggregates that form the state of ``measure``; DECIMAL money needs its sum alone."""
    names, x = state_columns(measure), f"`{measure}`"
    if is_exact(df, measure):
        return [F.sum(measure).alias(names.total)]
    return [
        F.expr(_limb_sums(x)).alias(names.total),
        F.expr(_beyond(x)).alias(names.beyond),
        F.sum(measure).alias(names.plain),
    ]


def has_limb_state(state: DataFrame, measure: str) -> bool:
    return state_columns(measure).beyond in state.columns


def state_merge(state: DataFrame, measure: str) -> list[Column]:
    """Aggregates that add up states of ``measure``."""
    names = state_columns(measure)
    if not has_limb_state(state, measure):
        return [F.sum(names.total).alias(names.total)]
    limbs = F.array(*[F.sum(F.get(names.total, F.lit(k))) for k in range(LIMBS)])
    return [limbs.alias(names.total), F.sum(names.beyond).alias(names.beyond), F.sum(names.plain).alias(names.plain)]


def state_sum(state: DataFrame, measure: str) -> Column:
    """ROUND(SUM(x), 2) as DOUBLE from a state."""
    names = state_columns(measure)
    if not has_limb_state(state, measure):
        return F.round(names.total, 2).cast("double")
    return F.expr(_state_sum(nearest_double(names.total), names.beyond, names.plain))


def state_mean(measure: str, count: str) -> Column:
    """ROUND(SUM(x) / count, 2) as DOUBLE from a DOUBLE measure's state; 0 for a count of 0."""
    names = state_columns(measure)
    return F.expr(_state_mean(nearest_double(names.total), names.beyond, names.plain, count))
