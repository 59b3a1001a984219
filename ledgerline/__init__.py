"""Ledgerline: user-level Spark jobs for reporting, cleaning, series features, text and scoring."""
