"""Helpers that shape physical plans: shared staging and skew splitting."""

from lumenfold.plans.skew import grid_join, salted_join
from lumenfold.plans.stage import clear_stage, shared_dir, stage

__all__ = ["clear_stage", "grid_join", "salted_join", "shared_dir", "stage"]
