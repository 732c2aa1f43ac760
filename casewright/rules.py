"""Phenotypes as data. Small value objects whose fields become Column predicates."""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import Enum

# The public defaults of windows, tolerances and counts.
TIER_WINDOW = (-30, 30)
LEAST_OBSERVATION_DAYS = 180
MATCH_YEARS, MATCH_DAYS = 5.0, 365
CONTROLS_WANTED, CONTROLS_LEAST = 4, 1
LAB_WINDOW, TRAUMA_WINDOW, SEPSIS_WINDOW, SUPPORTIVE_WINDOW = (-7, 45), (-7, 7), (-30, 0), (-30, 7)
LOOKBACK_DAYS, HORIZON_DAYS = 365, 730


@dataclass(frozen=True)
class Concepts:
    """A set of event concepts: ids, and case-insensitive literal substrings of the name. ``label`` names it in outputs."""

    ids: tuple[int, ...] = ()
    terms: tuple[str, ...] = ()
    label: str = ""


@dataclass(frozen=True)
class DayWindow:
    """Inclusive day offsets from an anchor; the anchor's own day is 0."""

    first: int
    last: int


@dataclass(frozen=True)
class Reading:
    """Lab concepts whose value reaches ``least`` (None: any value, even a missing one)."""

    concepts: Concepts
    least: float | None = None


class Evidence(Enum):
    """What a tier asks for."""

    CONDITION = "condition"
    LAB = "lab"
    BOTH = "both"
    EITHER = "either"

    @property
    def condition(self) -> bool:
        return self in (Evidence.CONDITION, Evidence.BOTH)

    @property
    def lab(self) -> bool:
        return self in (Evidence.LAB, Evidence.BOTH)


@dataclass(frozen=True)
class Tier:
    """A level of case certainty. ``window`` places the lab around the first condition where both are asked for."""

    evidence: Evidence
    conditions: Concepts = Concepts()
    reading: Reading = Reading(Concepts())
    window: DayWindow = DayWindow(*TIER_WINDOW)


@dataclass(frozen=True)
class PhenotypeRules:
    broad: Tier
    definite: Tier
    cofactors: tuple[Concepts, ...] = ()
    no_controls: Concepts = Concepts()
    observed_days: int = LEAST_OBSERVATION_DAYS

    @property
    def cofactor_names(self) -> list[str]:
        return [c.label for c in self.cofactors]

    @property
    def lab_alone(self) -> Tier:
        """The definite tier's lab without its condition, which marks the indeterminate group."""
        return Tier(Evidence.LAB, reading=self.definite.reading)


@dataclass(frozen=True)
class Tolerance:
    years: float = MATCH_YEARS
    days: int = MATCH_DAYS


@dataclass(frozen=True)
class Controls:
    """How many controls a case gets. ``whole``: a case below ``least`` gets none. ``reuse``: a control serves many cases."""

    wanted: int = CONTROLS_WANTED
    least: int = CONTROLS_LEAST
    whole: bool = False
    reuse: bool = False


@dataclass(frozen=True)
class Matching:
    tier: str = "broad"
    same: tuple[str, ...] = ("is_female", "ancestry_pred")
    within: Tolerance = Tolerance()
    controls: Controls = Controls()


@dataclass(frozen=True)
class IncidentRules:
    """Incident (time-at-risk) phenotype. Windows are inclusive day offsets from the first target date."""

    target: Concepts
    lab: Concepts
    lab_min: float
    lab_window: tuple[int, int] = LAB_WINDOW
    trauma: tuple[Concepts, ...] = ()
    sepsis: tuple[Concepts, ...] = ()
    supportive: tuple[Concepts, ...] = ()
    history: dict[str, tuple[Concepts, ...]] = field(default_factory=dict)
    labs: tuple[Concepts, ...] = ()
    lookback_days: int = LOOKBACK_DAYS
    horizon_days: int = HORIZON_DAYS
    trauma_window: tuple[int, int] = TRAUMA_WINDOW
    sepsis_window: tuple[int, int] = SEPSIS_WINDOW
    supportive_window: tuple[int, int] = SUPPORTIVE_WINDOW

    def __post_init__(self):
        # one bit of a 64-bit mask for each group of conditions
        if 4 + len(self.history) > 62:
            raise ValueError("at most 58 history features fit the day mask")
