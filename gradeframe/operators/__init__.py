"""Relational operators over the score tables (DataFrame in, DataFrame out)."""

from gradeframe.operators import dims, grace, stats, tables, topk

__all__ = ["dims", "grace", "stats", "tables", "topk"]
