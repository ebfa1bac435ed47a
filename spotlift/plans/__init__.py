"""Compositions: marts, measures, quality gate, QA report, scoring and the daily run."""
