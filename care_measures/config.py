"""Site settings: everything that belongs to one health centre rather than to a measure.

The views and scalar functions the reports rely on are not defined anywhere, so the
inferences made about them (consent fields, visit-type subsets, holidays) are collected
here instead of being spread over the measures.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from .functions.valuesets import ValueSet


@dataclass(frozen=True)
class ProviderRule:
    """Notes of ``provider`` on ``weekdays`` (Sunday = 1) after ``hour`` are after hours.

    ``minute`` adds the written-in condition ``minute(ts) >= minute``.
    """

    provider: str
    weekdays: tuple[int, ...]
    hour: int
    minute: int = 0


@dataclass(frozen=True)
class SiteConfig:
    company_id: int = 9
    agency: str = "AGENCY"
    # Extra "contains" pattern for the note-template black-list, usually the site's own name.
    own_name_pattern: str | None = None
    # Providers left out of most visit measures, and of the medical-provider list.
    excluded_providers: tuple[str, ...] = ()
    non_medical_providers: tuple[str, ...] = ()
    provider_rules: tuple[ProviderRule, ...] = ()
    # "as_written": the rules are joined by AND, so no note can satisfy all of them and
    # nothing is excluded. "any": a note matching one rule is excluded.
    after_hours: str = "as_written"
    # Visit-type subsets; None means every visit type.
    ops_visit_types: tuple[int, ...] | None = None
    valid_visit_types: tuple[int, ...] | None = None
    medical_visit_types: tuple[int, ...] | None = None
    # Observation fields of the two consent flags.
    telehealth_consent_field: int = 16001
    telephone_consent_field: int = 16002
    holidays: tuple[date, ...] = ()
    # Hysterectomy: as written anyone with any *other* diagnosis is kept.
    exclude_hysterectomy: bool = False
    # The reproductive-health diagnosis list runs to several hundred codes; it is loaded
    # per site, either as a ValueSet or as a ``value_set_code`` table.
    value_sets: dict[str, ValueSet] = field(default_factory=dict)
