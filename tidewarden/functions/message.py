"""Notification text as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import currency, detectors_text, fixed, is_true, percent, risk_mark, title

EVIDENCE_TYPE = (
    "struct<primary_kpi:string,evidence:array<struct<dimension:string,"
    "top:array<struct<segment:string,today:double,baseline:double,"
    "delta:double,pct_contrib:double>>>>>"
)

# Message wording.
NO_EVIDENCE = "No root cause evidence available."
NO_SUMMARY = "Root cause evidence present but not easily summarized."
UNREADABLE = "Root cause evidence present but could not be parsed."


# What stands for a part that a document does not have, and for a null.
ABSENT = {"primary_kpi": "unknown", "dimension": "unknown_dimension", "segment": "unknown", "delta": "0", "pct_contrib": "0"}
NULL_TEXT = "None"
DOCUMENT, BLOCKS = "map<string,string>", "array<map<string,string>>"


def _part(of: Column, key: str) -> Column:
    """A part of a document as text; absent and null are told apart."""
    return F.when(F.map_contains_key(of, key), F.try_element_at(of, F.lit(key))).otherwise(ABSENT[key])


def _named(of: Column, key: str) -> Column:
    return F.coalesce(_part(of, key), F.lit(NULL_TEXT))


def _driver(block: Column, top: Column) -> Column:
    first = F.get(top, F.lit(0))
    amount = lambda key: _part(first, key).try_cast("double")
    return F.concat(
        _named(block, "dimension"),
        F.lit(": top driver = "),
        _named(first, "segment"),
        F.lit(" (delta="),
        fixed(amount("delta"), 2),
        F.lit(", contribution="),
        percent(amount("pct_contrib"), 1),
        F.lit(")"),
    )


def _top(block: Column) -> Column:
    return F.from_json(F.try_element_at(block, F.lit("top")), BLOCKS)


def root_cause_summary_json(text: Column) -> Column:
    """One line from an evidence document as JSON text: the top driver of its first two
    dimensions. Parts the document lacks have names of their own."""
    document = F.from_json(text, DOCUMENT)
    listed = F.map_contains_key(document, "evidence")
    blocks = F.from_json(F.try_element_at(document, F.lit("evidence")), BLOCKS)
    shown = F.filter(F.slice(blocks, 1, 2), lambda b: is_true(F.size(_top(b)) > 0))
    drivers = F.concat_ws(" | ", F.transform(shown, lambda b: _driver(b, _top(b))))
    head = F.concat(F.lit("Primary KPI: "), _named(document, "primary_kpi"), F.lit(". "))
    # Broken JSON is NULL here, and so is what is no object or no list of them.
    unreadable = F.try_parse_json(text).isNull() | document.isNull() | (listed & blocks.isNull())
    return (
        F.when(text.isNull() | (text == ""), NO_EVIDENCE)
        .when(unreadable, UNREADABLE)
        .otherwise(F.concat(head, F.when(is_true(F.size(shown) > 0), drivers).otherwise(NO_SUMMARY)))
    )


def alert_message(
    *,
    ds: Column,
    kpi: Column,
    risk_level: Column,
    value: Column,
    baseline: Column,
    z_score: Column,
    detectors: Column,
    validation_status: Column,
    injected_label: Column,
    summary: Column,
) -> Column:
    """Notification text of one alert. Missing values read ``N/A``, and an alert
    without a label has no tag line."""
    risk = F.upper(F.coalesce(risk_level, F.lit("UNKNOWN")))
    money = is_true(F.lower(kpi) == "revenue")

    def amount(v: Column) -> Column:
        return F.when(money, currency(v)).otherwise(fixed(v, 2))

    when = F.date_format(ds.cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    tag = F.when(
        F.trim(injected_label) != "", F.concat(F.lit("\nSimulation Tag: "), injected_label)
    )
    lines = [
        F.concat(risk_mark(risk), F.lit(" *"), risk, F.lit(" KPI Alert*")),
        F.concat(F.lit("*Date:* "), F.coalesce(when, F.lit("N/A"))),
        F.concat(F.lit("*KPI:* "), title(F.coalesce(kpi, F.lit("unknown_kpi")))),
        F.concat(F.lit("*Observed Value:* "), amount(value)),
        F.concat(F.lit("*Baseline:* "), amount(baseline)),
        F.concat(F.lit("*Z-Score:* "), fixed(z_score, 2, grouped=False)),
        F.concat(F.lit("*Validation Status:* "), F.coalesce(validation_status, F.lit("UNKNOWN"))),
        F.concat(F.lit("*Detectors Fired:* "), F.coalesce(detectors_text(detectors), F.lit("N/A"))),
        F.concat(F.lit("*Root Cause Summary:* "), summary),
    ]
    return F.concat(F.concat_ws("\n", *lines), F.coalesce(tag, F.lit("")))
