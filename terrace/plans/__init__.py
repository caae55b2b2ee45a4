"""The warehouse itself: silver, staging, gold, checks, profiling, reports, pipeline."""
