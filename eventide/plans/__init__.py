"""Reusable plan shapes: skew-safe ordered scans and bucketed range joins."""
