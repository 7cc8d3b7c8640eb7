"""Landed vendor files to tidy tables."""
