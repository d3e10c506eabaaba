"""Backfill ranges and files."""
