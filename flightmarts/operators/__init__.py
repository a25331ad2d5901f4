"""DataFrame -> DataFrame operators: cleaning, enrichment, marts, checks, gate, counts."""

from flightmarts.operators import checks, gate, marts, reconcile
from flightmarts.operators.clean import cast_raw, clean, deduplicate, drop_missing_keys
from flightmarts.operators.enrich import enrich, stage

__all__ = [
    "cast_raw",
    "checks",
    "clean",
    "deduplicate",
    "drop_missing_keys",
    "enrich",
    "gate",
    "marts",
    "reconcile",
    "stage",
]
