"""Scalar column functions of the reports.

All are built-in Spark expressions (JVM side, inside whole-stage codegen);
none is a Python UDF.  Arguments may be column names or ``Column`` objects.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Report weights and role labels.
KILL_POINTS = 5
WIN_POINTS = 15
ATTACKER = "Attacker"
DEFENDER = "Defender"
ROLES = (ATTACKER, DEFENDER)
# Platform series buckets: the first two platform values get their own series,
# every other value falls into the last one.
PLATFORM_SERIES = ("pc", "ps4", "xbox")
DEFAULT_PLATFORM_BUCKETS = ("PC", "PS4")
# A remainder below this many units may be multiplied by 100 within a long.
WIDE_FROM = 9 * 10 ** 14


def _c(x) -> Column:
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x) if isinstance(x, (int, float)) else x


def int_div(a, b) -> Column:
    """Floor division of non-negative integers, exact (no float rounding)."""
    return F.call_function("div", _c(a).cast("long"), _c(b).cast("long"))


def division(operator="operator") -> Column:
    """Division of an operator label ``DIVISION-NAME``: its first dash token."""
    return F.split_part(_c(operator), F.lit("-"), F.lit(1))


def operator_name(operator="operator", strict: bool = False) -> Column:
    """Name part of ``DIVISION-NAME``: its second dash token ('' without a dash;
    with ``strict`` a label without a dash fails the job, as originally)."""
    name = F.split_part(_c(operator), F.lit("-"), F.lit(2))
    if not strict:
        return name
    fail = F.raise_error(F.concat(F.lit("operator label without a dash: "), _c(operator)))
    return F.when(_c(operator).contains("-") | _c(operator).isNull(), name).otherwise(fail.cast("string"))


def points(kills="kills", has_won="has_won", kill_points: int = KILL_POINTS,
           win_points: int = WIN_POINTS) -> Column:
    return _c(kills) * F.lit(kill_points) + _c(has_won) * F.lit(win_points)


def half_even_2(num, den) -> Column:
    """``num/den`` rounded to 2 places, ties to even, on the exact rational.

    Integral division only, so the result does not depend on how a binary
    double blurs a hundredth tie.  Both arguments are non-negative integers,
    ``den > 0``.  The hundredfold quotient is taken of whole part and remainder
    apart; only remainders past 9e14 leave long arithmetic, for decimals.
    """
    n, d = _c(num).cast("long"), _c(den).cast("long")
    whole, rest = F.call_function("div", n, d), n % d
    wide = F.lit(100).cast("decimal(3,0)") * rest.cast("decimal(19,0)")
    small = d <= F.lit(WIDE_FROM)
    part = F.when(small, F.call_function("div", rest * 100, d)).otherwise(
        F.call_function("div", wide, d.cast("decimal(19,0)")))
    r = F.when(small, rest * 100 - part * d).otherwise((wide % d.cast("decimal(19,0)")).cast("long"))
    # Twice the remainder against the divisor, without doubling past a long.
    up = (r > d - r) | ((r == d - r) & ((whole * 100 + part) % 2 == 1))
    q = whole * 100 + part + F.when(up, F.lit(1)).otherwise(F.lit(0))
    return q.cast("double") / F.lit(100.0)


def ratio2(num, den) -> Column:
    """Report ratio: ``round(num/den, 2)``, or ``num`` itself when ``den`` is 0."""
    return F.when(_c(den) == 0, _c(num).cast("double")).otherwise(half_even_2(num, den))


def hms(seconds) -> Column:
    """Seconds → ``HH:MM:SS``; hours keep every digit (``100:04:40``)."""
    t = _c(seconds).cast("long")
    return F.format_string("%02d:%02d:%02d", int_div(t, 3600), int_div(t % 3600, 60), t % 60)


def day_label(date="date") -> Column:
    """``yyyyMMdd`` → ``dd-MM-yyyy`` by slicing the text."""
    d = _c(date)
    return F.concat_ws("-", F.substring(d, 7, 2), F.substring(d, 5, 2), F.substring(d, 1, 4))


def is_day(date="date") -> Column:
    """Whether the text is a calendar day ``yyyyMMdd`` (never NULL)."""
    d = _c(date)
    day = F.try_to_timestamp(d, F.lit("yyyyMMdd"))
    return F.coalesce(d.rlike("^[0-9]{8}$") & day.isNotNull(), F.lit(False))


def platform_bucket(platform="platform", buckets=DEFAULT_PLATFORM_BUCKETS,
                    names=PLATFORM_SERIES) -> Column:
    """Map a platform to its series: listed values first, everything else last."""
    if len(names) != len(buckets) + 1:
        raise ValueError("need one series name per bucket plus one for the rest")
    p = _c(platform)
    expr = None
    for value, name in zip(buckets, names):
        expr = F.when(p == value, F.lit(name)) if expr is None else expr.when(p == value, F.lit(name))
    return expr.otherwise(F.lit(names[-1]))


def score(kill_ratio="kill_ratio", round_ratio="round_ratio", kill_divisor: int = 3) -> Column:
    """Ranking score ``kill_ratio / k + round_ratio`` on the rounded ratios."""
    return _c(kill_ratio) / F.lit(kill_divisor) + _c(round_ratio)


def role_flag(role_col, win_role_col) -> Column:
    return F.when(_c(role_col) == _c(win_role_col), F.lit(1)).otherwise(F.lit(0))
