"""Base tables, decoded change feeds and snapshots."""
