"""Wire codec of the message stream.

A message is one JSON array of two arrays, ``[[date, match_id], [13 fields]]``.
``encode_wire(style="python")`` writes the producer's exact text (``", "``
separators, the four count fields as JSON numbers, the rest as JSON strings);
``style="compact"`` writes ``to_json`` of a string array.  ``decode_wire``
parses with ``from_json`` (numbers or strings, any spacing, values with
spaces, commas or quotes), or with ``mode="legacy"``, the original
strip-and-split-on-space rule, which cannot carry spaces in values.
Undecodable messages are kept and flagged in ``_error``, never dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_day
from ..schema import INT_COLUMNS, WIRE_KEY, WIRE_NUMERIC, WIRE_VALUE

# Characters the legacy decoder strips before splitting on a space.
LEGACY_STRIP = "[],'\""
WIRE_FIELDS = WIRE_KEY + WIRE_VALUE


def _json_string(c: Column) -> Column:
    """JSON text of one string value, quotes and escapes included."""
    j = F.to_json(F.array(c.cast("string")))
    return F.substring(j, F.lit(2), F.length(j) - F.lit(2))


def _python_cell(name: str) -> Column:
    c = F.col(name)
    if name in WIRE_NUMERIC:
        return F.coalesce(c.cast("string"), F.lit("null"))
    return _json_string(c)


def wire_value(style: str = "python") -> Column:
    if style == "python":
        key = F.concat_ws(", ", *[_python_cell(n) for n in WIRE_KEY])
        val = F.concat_ws(", ", *[_python_cell(n) for n in WIRE_VALUE])
        return F.concat(F.lit("[["), key, F.lit("], ["), val, F.lit("]]"))
    if style == "compact":
        return F.to_json(F.array(F.array(*[F.col(n).cast("string") for n in WIRE_KEY]),
                                 F.array(*[F.col(n).cast("string") for n in WIRE_VALUE])))
    raise ValueError("style must be 'python' or 'compact'")


def encode_wire(pr: DataFrame, style: str = "python", keep: tuple = ()) -> DataFrame:
    """Canonical rows → ``value`` message text (plus the ``keep`` columns)."""
    return pr.select(*keep, wire_value(style).alias("value"))


def _typed(cells: list[Column]) -> list[Column]:
    """The cells as canonical columns.

    The integers come out of one ``transform``.  Spark compiles a projection that holds
    one in small methods; as one method of a whole stage this one would be too long for
    the JVM to compile, and several times slower.
    """
    ints = F.transform(F.array(*[c for n, c in zip(WIRE_FIELDS, cells) if n in INT_COLUMNS]),
                       lambda c: F.trim(c).try_cast("int"))
    names = [n for n in WIRE_FIELDS if n in INT_COLUMNS]
    return [F.get(ints, names.index(n)) if n in INT_COLUMNS else c for n, c in zip(WIRE_FIELDS, cells)]


def _int_errors(cells: list[Column], typed: list[Column]) -> tuple[Column, Column]:
    """(a required integer is NULL, a cell that should be an integer is none)."""
    null, bad = F.lit(False), F.lit(False)
    for name, c, v in zip(WIRE_FIELDS, cells, typed):
        if name in INT_COLUMNS:
            null = null | c.isNull()
            bad = bad | (c.isNotNull() & v.isNull())
    return null, bad


def decode_wire(msgs: DataFrame, mode: str = "json", value_col: str = "value",
                keep: tuple = (), strict: bool = False) -> DataFrame:
    """Message text → canonical columns + ``_error`` (NULL when the row is good),
    after the ``keep`` columns of the input.

    ``_error`` is the first that holds of ``not_json`` / ``not_text``, ``arity``,
    ``bad_int``, ``null_field`` (a NULL integer or match_id) and ``bad_date`` (no
    ``yyyyMMdd`` calendar day).  Each message is parsed once: the decoded row
    leaves through ``explode``, which filters on ``_error`` do not pass.

    With ``strict`` a bad message fails the job instead of being flagged.
    """
    v = F.col(value_col).cast("string")
    m = F.col("_m")
    # get() returns NULL past the end of an array, also under ANSI mode.
    if mode == "json":
        parsed = msgs.select(*keep, F.from_json(v, "array<array<string>>").alias("_m"))
        cells = ([F.get(F.get(m, 0), i) for i in range(len(WIRE_KEY))]
                 + [F.get(F.get(m, 1), i) for i in range(len(WIRE_VALUE))])
        err = (F.when(m.isNull(), F.lit("not_json"))
               .when((F.size(m) != 2) | (F.size(F.get(m, 0)) != len(WIRE_KEY))
                     | (F.size(F.get(m, 1)) != len(WIRE_VALUE)), F.lit("arity")))
    elif mode == "legacy":
        parsed = msgs.select(*keep, F.split(F.translate(v, LEGACY_STRIP, ""), " ").alias("_m"))
        cells = [F.get(m, i) for i in range(len(WIRE_FIELDS))]
        err = (F.when(m.isNull(), F.lit("not_text"))
               .when(F.size(m) != len(WIRE_FIELDS), F.lit("arity")))
    else:
        raise ValueError("mode must be 'json' or 'legacy'")
    typed = _typed(cells)
    null, bad = _int_errors(cells, typed)
    text = dict(zip(WIRE_FIELDS, cells))
    err = (err.when(bad, F.lit("bad_int")).when(null | text["match_id"].isNull(), F.lit("null_field"))
           .when(~is_day(text["date"]), F.lit("bad_date")).otherwise(F.lit(None).cast("string")))
    row = F.struct(*[c.alias(n) for n, c in zip(WIRE_FIELDS, typed)], err.alias("_error"))
    out = (parsed.select(*keep, row.alias("_row")).select(*keep, F.explode(F.array("_row")).alias("_row"))
           .select(*keep, "_row.*"))
    if strict:
        # Folded into a kept column so the check cannot be pruned away.
        fail = F.raise_error(F.concat(F.lit("undecodable message: "), F.col("_error")))
        out = out.withColumn("date", F.when(F.col("_error").isNotNull(), fail.cast("string"))
                             .otherwise(F.col("date")))
    return out
