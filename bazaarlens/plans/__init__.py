"""Whole plans: the master table, feature tables, reports and the pipeline."""
