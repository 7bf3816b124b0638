"""Reads: day-partitioned scans (A1-A5) and the stand-in roles built from the test tables."""

from livemetrics.sources.tables import (
    compact_day_scan, day_range, day_scan, lagged_day, read_table, valid_rooms,
)

__all__ = ["compact_day_scan", "day_range", "day_scan", "lagged_day", "read_table", "valid_rooms"]
