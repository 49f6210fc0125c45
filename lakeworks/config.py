"""Run parameters (replaces the reference's session variables)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Fixed values shared by the Spark builders and the SQL oracles.
AS_OF = dt.date(2001, 12, 31)          # "today" for lineitem / orders roles
EVENTS_AS_OF = dt.date(2024, 1, 31)    # "today" for the events roles
OPEN_START = dt.date(1900, 1, 1)
OPEN_END = dt.date(9999, 12, 31)

# Currency of a portfolio = CURRENCIES[n_nationkey % 6]
CURRENCIES = ["USD", "EUR", "GBP", "JPY", "CAD", "AUD"]
# Made-up FX base rates to USD in units of 1e-4 (EUR 1.20, GBP 1.50, JPY 0.01, CAD 0.80, AUD 0.70)
FX_BASE_E4 = {"EUR": 12000, "GBP": 15000, "JPY": 100, "CAD": 8000, "AUD": 7000}
FX_EPOCH = dt.date(1995, 1, 1)
FX_GAP_EVERY = 97                       # days with day_index % 97 = 0 have no rate

# Rating letter -> ordinal score (fixed values)
RATING_SCORES = {"AAA": 1, "AA": 2, "A": 3, "BBB": 4, "BB": 5, "B": 6,
                 "CCC": 7, "CC": 8, "C": 9, "D": 10}

SOURCES = ("state_street", "aladdin", "aspen", "efront", "internal_admin", "bloomberg")


@dataclass(frozen=True)
class LakeConfig:
    as_of: dt.date = AS_OF
    events_as_of: dt.date = EVENTS_AS_OF
    skip_sources: frozenset = field(default_factory=frozenset)
    skip_teams: frozenset = field(default_factory=frozenset)
    fx_missing: str = "one"   # "one" keeps the reference default, "null" leaves NULL
