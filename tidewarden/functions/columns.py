"""Scalar column expressions: safe arithmetic, coercion, lookups, formatting.

Spark compares NaN as larger than any number and, in ANSI mode, raises on a zero
denominator. The series logic wants neither, so NaN becomes NULL where data enter
and every division goes through ``ratio``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Severity order of risk levels, and the mark shown for each.
RISK_RANK = {"HIGH": 3, "MEDIUM": 2, "LOW": 1}
RISK_MARK = {"HIGH": "🔴", "MEDIUM": "🟠", "LOW": "🟡"}
OTHER_MARK = "⚪"

# The detectors, in the order they are shown.
DETECTORS = ("rule", "z", "iqr", "iforest")


def number(col: Column) -> Column:
    """A double, with unreadable values and NaN as NULL."""
    v = col.try_cast("double")
    return F.when(~F.isnan(v), v)


def timestamp(col: Column) -> Column:
    """A timestamp without a zone, so that no session setting shifts its day, with
    unreadable values as NULL."""
    return col.try_cast("timestamp_ntz")


def day(col: Column) -> Column:
    """A date, with unreadable values as NULL."""
    return col.try_cast("date")


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as double, NULL where the denominator is 0 or NULL."""
    return F.try_divide(top.cast("double"), F.nullif(bottom.cast("double"), F.lit(0.0)))


def deviation(value: Column, baseline: Column) -> Column:
    """Relative distance of a value from its baseline."""
    return ratio(value - baseline, baseline)


def decisive(col: Column) -> Column:
    """Rounded to twelve places before it is compared with a threshold, so that the last
    bits of a sum, which depend on its order, do not decide."""
    return F.round(col, 12)


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join on equal keys in which NULL equals NULL: a series without a name is one
    too. The result has the left side's keys."""
    other = right.select(*[F.col(c).alias(f"__{c}" if c in keys else c) for c in right.columns])
    same = reduce(Column.__and__, [left[k].eqNullSafe(other[f"__{k}"]) for k in keys])
    return left.join(other, same, how).drop(*[f"__{k}" for k in keys])


def is_true(col: Column) -> Column:
    """A condition with unknown as false."""
    return F.coalesce(col, F.lit(False))


def lookup(col: Column, table: dict, default) -> Column:
    """Value of ``table`` for ``col``, or ``default`` where there is none."""
    out = F.lit(default)
    for key, value in table.items():
        out = F.when(col == F.lit(key), F.lit(value)).otherwise(out)
    return out


def risk_rank(level: Column) -> Column:
    return lookup(F.upper(level), RISK_RANK, 0)


def risk_mark(level: Column) -> Column:
    return lookup(F.upper(level), RISK_MARK, OTHER_MARK)


def fixed(value: Column, places: int, grouped: bool = True) -> Column:
    """Decimal text, with or without thousands separators; ``N/A`` for NULL."""
    text = F.format_number(value.cast("double"), places)
    if not grouped:
        text = F.replace(text, F.lit(","), F.lit(""))
    return F.coalesce(text, F.lit("N/A"))


def currency(value: Column) -> Column:
    text = fixed(value, 2)
    return F.when(text == "N/A", text).otherwise(F.concat(F.lit("$"), text))


def percent(value: Column, places: int) -> Column:
    text = fixed(value * 100, places, grouped=False)
    return F.when(text == "N/A", text).otherwise(F.concat(text, F.lit("%")))


def title(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def detector_struct(**flags: Column) -> Column:
    return F.struct(*[is_true(flags[d]).alias(d) for d in DETECTORS])


def detector_count(detectors: Column) -> Column:
    """Number of detectors that fired; 0 for NULL."""
    return sum(
        (F.when(is_true(detectors[d]), 1).otherwise(0) for d in DETECTORS[1:]),
        F.when(is_true(detectors[DETECTORS[0]]), 1).otherwise(0),
    )


def detectors_text(detectors: Column) -> Column:
    """The detector flags as they are shown in messages and CSV files."""
    pairs = [
        F.concat(
            F.lit(f"'{d}': "),
            F.when(is_true(detectors[d]), "True").otherwise("False"),
        )
        for d in DETECTORS
    ]
    text = F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}"))
    return F.when(detectors.isNotNull(), text)


def _flags(text: Column) -> Column:
    """Every entry of a detector text with its value as text. The text is valid JSON once
    its quotes and constants are respelled."""
    spelled = F.replace(text, F.lit("'"), F.lit('"'))
    for word, json in (("True", "true"), ("False", "false"), ("None", "null")):
        spelled = F.regexp_replace(spelled, rf"(?<=[:\s]){word}(?=\s*[,}}])", json)
    return F.from_json(spelled, "map<string,string>")


def _fired(value: Column) -> Column:
    """Truth by value: not null, false, zero or empty."""
    amount = value.try_cast("double")
    return is_true((F.lower(value) != "false") & (value != "") & F.coalesce(amount != 0, F.lit(True)))


def detectors_from_text(text: Column) -> Column:
    """The known flags read back from that text; unreadable text gives none that fired."""
    flags = _flags(text)
    fired = detector_struct(**{d: _fired(F.try_element_at(flags, F.lit(d))) for d in DETECTORS})
    return F.when(text.isNotNull(), fired)


def detector_count_of_text(text: Column) -> Column:
    """Number of detectors that fired in a detector text, whatever their names."""
    values = F.map_values(_flags(text))
    return F.coalesce(F.size(F.filter(values, _fired)), F.lit(0))
