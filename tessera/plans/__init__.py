"""Logical plans: marts, measures, pages, quality, backfill, jobs."""
