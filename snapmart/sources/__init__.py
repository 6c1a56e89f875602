"""Readers of landing files and writers of tables and reports."""
