"""Operators bound to the driver tables, each with its DuckDB oracle SQL."""

from florapipe.plans import (audits, load_bind, media_bind, merge_load, resolution,  # noqa: F401
                             species_jobs, stored_joins,
                             stream_bind, targets, text_bind)
from florapipe.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
