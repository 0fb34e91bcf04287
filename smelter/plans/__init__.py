"""Flows, the medallion pipeline and the catalogue of queries."""
