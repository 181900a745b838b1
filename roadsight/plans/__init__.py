"""Reusable plan shapes: bounded broadcast, bucketed range joins, ordered
per-key scans that stay parallel under key skew, global numbering."""
