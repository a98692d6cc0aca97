"""Scalar rules: coercions, classes, rounding and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text cells a CSV reader treats as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Activity types grouped into reporting categories; anything else is 'other'.
ACTIVITY_CATEGORIES = {
    "communication": ["forumng", "glossary"],
    "content": ["oucontent", "htmlactivity", "page", "subpage"],
    "assessment": ["quiz", "externalquiz", "questionnaire"],
    "reference": ["resource", "url", "folder", "sharedsubpage"],
    "tool": ["homepage", "dataplus", "dualpane", "repeatactivity"],
}

# Last letter of the presentation code names the start month.
PRESENTATION_STARTS = {"B": "February", "J": "October"}

PASS_MARK = 40

# Decimal for sums and means: twelve digits after the point, sixteen before it (a sum has more).
EXACT = "decimal(28,12)"
DAYS_PER_WEEK = 7


def blank_na(c: Column) -> Column:
    """NULL for any missing-value token, the text unchanged otherwise."""
    return F.when(~c.isin(NA_TOKENS), c)


# What counts as a number; a plain cast would also take suffixes such as 12d or 7F.
NUMBER = r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
LONG_LIMIT = 2.0 ** 63


def to_double(c: Column) -> Column:
    """Numeric value of a cell, NULL when it is not a number."""
    cell = blank_na(c)
    return F.when(cell.rlike(NUMBER), cell).try_cast("double")


def to_long(c: Column) -> Column:
    """Whole part of a numeric cell, NULL when it is not a number or has no 64-bit value. Whole
    numbers are read as they stand, so that large ids stay apart."""
    number = to_double(c)
    inside = (number > -LONG_LIMIT) & (number < LONG_LIMIT)
    return F.coalesce(F.trim(blank_na(c)).try_cast("bigint"),
                      F.when(inside, number).try_cast("bigint"))


def to_long_or_zero(c: Column) -> Column:
    """Whole part of a numeric cell, 0 when it is not a number."""
    return F.coalesce(to_long(c), F.lit(0).cast("bigint"))


def presentation_start(code: Column) -> Column:
    rule = None
    for letter, month in PRESENTATION_STARTS.items():
        hit = F.right(code, F.lit(1)) == letter
        rule = F.when(hit, month) if rule is None else rule.when(hit, month)
    return rule.otherwise("Unknown")


def activity_category(activity: Column) -> Column:
    rule = None
    for category, types in ACTIVITY_CATEGORIES.items():
        hit = activity.isin(types)
        rule = F.when(hit, category) if rule is None else rule.when(hit, category)
    return rule.otherwise("other")


def registration_timing(day: Column) -> Column:
    """early / on_time / late by day offset; an unknown day counts as late."""
    return F.when(day < 0, "early").when(day == 0, "on_time").otherwise("late")


def assessment_result(score: Column) -> Column:
    return (
        F.when(score.isNull(), "not_submitted")
        .when(score >= PASS_MARK, "passed")
        .otherwise("failed")
    )


def week_number(day: Column) -> Column:
    """Week holding a day offset; days before the start fall in negative weeks."""
    return F.floor(day / DAYS_PER_WEEK).cast("bigint")


def ratio(num: Column, den: Column) -> Column:
    """num / den as double, NULL when den is 0."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def round_half_up(c: Column, digits: int) -> Column:
    """Half-up rounding of the decimal value, so that 0.285 gives 0.29 on every engine."""
    return F.round(c.cast(EXACT), digits).cast("double")


def exact_mean(c: Column) -> Column:
    """Mean over exact decimal sums: the result does not depend on the order of the rows."""
    return ratio(F.sum(c.cast(EXACT)), F.count(c))


def one_decimal(c: Column) -> Column:
    """Text with one decimal, for labels."""
    return c.cast("decimal(18,1)").cast("string")
