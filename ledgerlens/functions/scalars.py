"""Amount, time, address and ratio expressions. Arguments and results are SQL text."""

from __future__ import annotations

import math

from .sqltext import lit


def flag(condition: str) -> str:
    """1 when the condition holds, 0 when it does not or is unknown."""
    return f"coalesce(CAST(({condition}) AS INT), 0)"


def to_number(col: str) -> str:
    """Number or null; text that is no number becomes null instead of failing the job."""
    return f"nullif(try_cast({col} AS DOUBLE), CAST('NaN' AS DOUBLE))"


def log_amount(amount: str) -> str:
    return f"log1p({amount})"


def log_distance(distance: str) -> str:
    return f"log1p(coalesce({to_number(distance)}, 0D))"


def decimal_part(amount: str) -> str:
    """Fraction times 1000, truncated; 0 for a missing amount."""
    return f"coalesce(CAST(({amount} - CAST({amount} AS BIGINT)) * 1000 AS INT), 0)"


def cents(amount: str) -> str:
    """`amount * 100 % 100` with a floored remainder, truncated; 0 for a missing amount."""
    return f"coalesce(CAST(pmod({amount} * 100D, 100D) AS INT), 0)"


def is_round(amount: str) -> str:
    return flag(f"{amount} = CAST({amount} AS BIGINT)")


def right_closed_bin(value: str, edges, missing=None, open_end: bool = False) -> str:
    """Index of the interval `(lo, hi]` holding the value. At or below the first edge, or
    above the last one (unless `open_end`), the result is `missing`."""
    steps = [f"WHEN {value} IS NULL OR {value} <= {lit(edges[0])} THEN {lit(missing)}"]
    steps += [f"WHEN {value} <= {lit(edge)} THEN {code}" for code, edge in enumerate(edges[1:])]
    last = len(edges) - 1 if open_end else missing
    return f"CASE {' '.join(steps)} ELSE {lit(last)} END"


def amount_bin(amount: str, edges) -> str:
    """Amount bin as a double; the value is narrowed to single precision first."""
    single = f"CAST(CAST({amount} AS FLOAT) AS DOUBLE)"
    return f"CAST({right_closed_bin(single, [float(e) for e in edges], open_end=True)} AS DOUBLE)"


def hour_of_day(seconds: str) -> str:
    """Hour 0-23 of an offset in seconds; offsets before zero wrap like clock time."""
    return f"CAST(pmod(floor({seconds} / 3600), 24) AS INT)"


def second_of_day(seconds: str) -> str:
    return f"CAST(pmod({seconds}, 86400) AS INT)"


def time_of_day(hour: str, edges) -> str:
    return right_closed_bin(hour, list(edges), missing=-1)


def is_night(hour: str) -> str:
    return flag(f"{hour} >= 0 AND {hour} < 6")


def is_business_hour(hour: str) -> str:
    return flag(f"{hour} >= 9 AND {hour} <= 17")


def hour_sine(hour: str) -> str:
    return f"sin({hour} * {lit(2 * math.pi)} / 24)"


def hour_cosine(hour: str) -> str:
    return f"cos({hour} * {lit(2 * math.pi)} / 24)"


def ratio(numerator: str, denominator: str, guard: float) -> str:
    """`numerator / (denominator + guard)`, null when that is zero."""
    return f"try_divide({numerator}, {denominator} + {lit(float(guard))})"


def missing_flag(col: str) -> str:
    return f"CAST({col} IS NULL AS INT)"


def version_number(name: str) -> str:
    """`k` of a `..._v<k>` name, null when there is none."""
    return f"try_cast(regexp_extract({name}, '_v([0-9]+)$', 1) AS INT)"
