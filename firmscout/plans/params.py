"""What a run is asked for: date, region, age, texts, score and size."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from datetime import date

# The region used when no postcodes are given, and the other defaults.
DEFAULT_POSTCODES = (
    "9400",
    "9402",
    "9406",
    "9300",
    "1770",
    "1760",
    "1750",
    "9500",
    "9620",
    "1700",
    "1540",
)
DEFAULT_COUNTRY = "BE"
SUPPORTED_COUNTRIES = ("BE",)
DEFAULT_MONTHS = 18
# The lowest score and the number of leads of a run from the command line.
COMMAND_LINE = {"min_score": 40, "limit": 200}


def parse_postcodes(text: str) -> tuple[str, ...]:
    """Postcodes of a comma-separated list, the default region when it names none."""
    codes = []
    for item in text.split(","):
        lone = re.search(r"\b[0-9]{4}\b", item)
        codes.append(lone.group() if lone else item.strip())
    named = tuple(dict.fromkeys(c for c in codes if c))
    return named or DEFAULT_POSTCODES


@dataclass(frozen=True)
class LeadParams:
    """Parameters of a lead run.

    ``as_of`` is the day ages are counted to. ``postcodes`` may be empty, which
    means every region. ``limit`` 0 means all. Nothing is cut off unless asked
    for; ``LeadParams(..., **COMMAND_LINE)`` has the cuts of a command line run.
    """

    as_of: date
    country: str = DEFAULT_COUNTRY
    city: str = ""
    query: str = ""
    postcodes: tuple[str, ...] = DEFAULT_POSTCODES
    months: int = DEFAULT_MONTHS
    min_score: int = 0
    limit: int = 0
    lite: bool = False
    on_invalid: str = "quarantine"

    def __post_init__(self) -> None:
        if self.country.strip().upper() not in SUPPORTED_COUNTRIES:
            raise ValueError(f"unsupported country '{self.country}', supported: {', '.join(SUPPORTED_COUNTRIES)}")
        if self.months < 1:
            raise ValueError("months must be at least 1")
        if self.limit < 0:
            raise ValueError("limit must not be negative")
        if not 0 <= self.min_score <= 100:
            raise ValueError("min_score must lie between 0 and 100")
        if self.on_invalid not in ("fail", "drop", "quarantine"):
            raise ValueError("on_invalid must be fail, drop or quarantine")

    @property
    def score_floor(self) -> int:
        """The lowest score let through; lite leads all score 0 and all pass."""
        return 0 if self.lite else self.min_score

    def but(self, **changes) -> LeadParams:
        return replace(self, **changes)
