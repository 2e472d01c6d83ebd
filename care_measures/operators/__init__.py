"""Reusable DataFrame operators.

Facts are always reduced with a map-side step (a window group limit or a partial
aggregate) before they are shuffled on a patient, visit or booking key, so a key holding a
large share of the rows costs at most one row per input partition.
"""

from .booking import next_booking, responses_wide
from .consents import extend_state, in_force
from .events import milestones, stage_durations
from .evidence import code_mask, evidence, has
from .filters import cohort, exclude_after_hours, exclude_by_name, ids_of
from .labs import lab_results
from .lookup import asof_value, bracket_lookup, follow_up_within
from .observations import (Lookup, consent_flags, daily_observations, in_window,
                           latest_observations, observations_asof, observations_exact, observe,
                           on_day, up_to_day)
from .ranking import current_version, earliest_per_key, latest_if_within, latest_per_key
from .report import report
from .slots import slot_any_match, slot_join

__all__ = [
    "Lookup", "asof_value", "bracket_lookup", "code_mask", "cohort", "consent_flags", "current_version",
    "daily_observations", "earliest_per_key", "evidence", "exclude_after_hours", "exclude_by_name", "extend_state",
    "follow_up_within", "has", "ids_of", "in_force", "in_window", "lab_results", "latest_if_within", "latest_observations", "latest_per_key",
    "milestones", "next_booking", "observations_asof", "observations_exact", "observe", "on_day", "report",
    "responses_wide", "slot_any_match", "slot_join", "stage_durations", "up_to_day",
]
