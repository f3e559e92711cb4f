"""Readers and writers: raw bars, stage tables, reports, models."""
