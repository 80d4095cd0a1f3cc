"""Readers and writers: raw CSV, monthly snapshot tables, report tables, model registry."""
