"""Cohort, session-merge and graduate reporting as Spark DataFrame jobs."""
