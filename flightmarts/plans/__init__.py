"""Driver programs: the monthly run, full clean, backfill; registered queries and oracles."""

from flightmarts.plans.monthly import backfill, clean_history, materialize_marts, run_month

__all__ = ["backfill", "clean_history", "materialize_marts", "run_month"]
