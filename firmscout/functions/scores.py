"""Rule scores: each rule is a condition, its points and its reason label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmscout.functions.sectors import is_high_value

Rule = tuple[Column, int, str]

# Lowest and highest lead score.
SCORE_FLOOR, SCORE_CEILING = 0, 100


def points(rules: Sequence[Rule]) -> Column:
    total = F.lit(0)
    for condition, worth, _ in rules:
        if worth:
            total = total + F.when(condition, F.lit(worth)).otherwise(F.lit(0))
    return total.cast("int")


def reasons(rules: Sequence[Rule]) -> Column:
    """Labels of the rules that hold, in rule order, joined by a pipe."""
    return F.concat_ws("|", *[F.when(condition, F.lit(label)) for condition, _, label in rules])


def contact_rules(phone: Column, email: Column, website: Column) -> list[Rule]:
    # Points and labels.
    return [
        (phone.isNotNull(), 5, "has_phone"),
        (email.isNotNull(), 3, "has_email"),
        (website.isNotNull(), 0, "has_website"),
    ]


def lead_rules(
    age: Column, max_months: int, sector: Column, code: Column, phone: Column, email: Column, website: Column
) -> list[Rule]:
    # Points and labels; the age label names 18 months whatever the limit is.
    return [
        (age <= max_months, 30, "new<18m"),
        (is_high_value(sector), 15, "sector_high"),
        (code.isNull(), -5, "no_nace"),
        *contact_rules(phone, email, website),
    ]


def lead_score(rules: Sequence[Rule]) -> Column:
    return F.greatest(F.lit(SCORE_FLOOR), F.least(F.lit(SCORE_CEILING), points(rules)))


def lite_reasons(phone: Column, email: Column, website: Column) -> Column:
    return reasons([(F.lit(True), 0, "lite_mode"), *contact_rules(phone, email, website)])


def gap_rules(
    recent: Column, months: int, sector: Column, phone: Column | None, email: Column | None, code: Column | None
) -> list[Rule]:
    """Rules of the second scorer, which rewards *missing* contacts.

    ``phone``, ``email`` and ``code`` are missing-value tests, None when the
    frame has no such column.
    """
    # Points and labels.
    rules: list[Rule] = [
        (recent, 30, f"new<{months}m;+30"),
        (is_high_value(sector), 15, "sector;+15"),
    ]
    if phone is not None:
        rules.append((phone, 5, "missing_phone;+5"))
    if email is not None:
        rules.append((email, 5, "missing_email;+5"))
    if code is not None:
        rules.append((code, -5, "missing_nace;-5"))
    return rules
