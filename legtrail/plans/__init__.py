"""Whole runs made of the operators: ingest, backfill, consolidate, explore."""
