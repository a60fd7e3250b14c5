"""Whole jobs: enrichment, star schema, KPIs, stream health."""
