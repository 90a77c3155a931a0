"""End-to-end flows built from the operators."""

from tallyframe.plans.analysis import profile_tables, run_analysis, score_file, score_with_saved

__all__ = ["profile_tables", "run_analysis", "score_file", "score_with_saved"]
