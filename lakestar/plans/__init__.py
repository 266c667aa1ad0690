"""Whole jobs: ingest, refine, load, and the registered queries."""
