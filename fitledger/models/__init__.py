"""Fit, save, score, and run a function per rank."""

from fitledger.models.fit import load_model, save_model, supervised_fit
from fitledger.models.linear import LinearTextModel, linear_text_model, loader
from fitledger.models.ranks import run_per_rank
from fitledger.models.score import batch_score, foreign_scores, score_prompts

__all__ = [
    "LinearTextModel", "batch_score", "foreign_scores", "linear_text_model", "load_model", "loader", "run_per_rank",
    "save_model", "score_prompts", "supervised_fit",
]
