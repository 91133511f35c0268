"""Outputs: published tables and views, CSV exports, the audit log."""
