"""End-to-end jobs: datamart backfill, training, scoring, monitoring."""
