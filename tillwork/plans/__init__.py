"""Operators wired into the reports: registered queries, order of presentation."""
