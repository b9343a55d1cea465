"""Whole queries: SQL text over views, and the registered queries with their check SQL."""

from millrace.plans.sql import run_sql

__all__ = ["run_sql"]
