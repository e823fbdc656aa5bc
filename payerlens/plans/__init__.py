"""Whole jobs: the reports, the end-to-end pipeline and the registered queries."""
