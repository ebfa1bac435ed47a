"""Readers, catalog tables, CSV sinks and the binding to the retail test tables."""
