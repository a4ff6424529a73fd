"""Operators: DataFrames and thresholds in, a lazy DataFrame out.

Row-level inputs are aggregated on their own key before any join, so a key that
holds a large share of the rows reaches the shuffle as one row per task, and
windows run only on rows whose group size the calendar bounds.  Results are
unsorted unless a limit needs the order; see ``tillwork.plans.reports``.
"""
