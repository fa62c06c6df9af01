"""Marketplace analytics as Spark plans: raw datasets to master, features and reports."""
