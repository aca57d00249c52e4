"""Batch lakehouse for trip records: landing files, raw, silver and gold tables, and their validation."""

from tripline.contract import Lakehouse, Period

__all__ = ["Lakehouse", "Period"]
