"""Settings: match stages, profiles, column names and thresholds."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Stage:
    """A match stage: the row's rule, its order, the least score that wins and whether a win teaches the master."""

    name: str
    order: int
    score: float
    min_score: float
    learns: bool = False
    enabled: bool = True


STAGES = (
    Stage("CANONICAL_EXACT", 1, 100.0, 3.0, learns=True),
    Stage("PHRASE_SLOP", 2, 95.0, 5.0),
    Stage("TOKEN_COVERAGE", 3, 90.0, 3.0),
)


@dataclass(frozen=True)
class Profile:
    """How names are read and matched.

    intended: one Unicode-aware cleaner on both sides, and key equality lets TOKEN_COVERAGE win.
    as_written: the write side keeps ASCII letters only, and TOKEN_COVERAGE scores 0, so it never wins.
    """

    name: str = "intended"
    unicode_cleaner: bool = True
    token_coverage_wins: bool = True
    #: Gates (each can be turned off).
    core_gate: bool = True
    input_filter: bool = True
    dirty_data: bool = True
    min_core_token: int = 2
    slop: int = 1
    stages: tuple[Stage, ...] = STAGES


#: Labels of match types that old tables may still hold, and the present types that took their place.
LEGACY_TYPES = {"EXACT_FUZZY": "CANONICAL_EXACT", "ADDRESS_CLEAN_MATCH": "CANONICAL_EXACT", "SUBSET_MATCH": "TOKEN_COVERAGE"}
INTENDED = Profile()
#: The retired phrase stage with more room between words.
WIDE = Profile("wide", slop=3)
AS_WRITTEN = Profile("as_written", unicode_cleaner=False, token_coverage_wins=False)
PROFILES = {p.name: p for p in (INTENDED, AS_WRITTEN, WIDE)}


@dataclass(frozen=True)
class ColumnMapping:
    """Physical names of the logical columns; None where the table has no such column."""

    id: str = "id"
    company_name: str = "company_name"
    country_code: str = "country_code"
    master_code: str | None = "master_code"
    match_score: str | None = "match_score"
    match_type: str | None = "match_type"
    match_details: str | None = "match_details"
    tax_number: str | None = None
    phone_number: str | None = None
    address: str | None = None

    def physical(self) -> dict[str, str]:
        return {k: v for k, v in self.__dict__.items() if v is not None}


#: Columns that must exist, and result columns that are added when they are missing, with their types.
REQUIRED = ("id", "company_name", "country_code")
RESULTS = {"master_code": "string", "match_score": "double", "match_type": "string", "match_details": "string"}
MATCHED_TYPES = tuple(s.name for s in STAGES)
NEW_TYPES = ("NEW_MASTER", "DIRTY_DATA")
SCORES = {s.name: s.score for s in STAGES} | {"NEW_MASTER": 100.0, "DIRTY_DATA": 100.0, "EXCLUDED": 0.0}


@dataclass(frozen=True)
class QaSettings:
    overlap_threshold: float = 0.3
    samples: int = 5
    #: Distinct cores of a master that one task compares with all of them.
    piece: int = 1000
