"""Named read models (views, checks, reports) and the batch jobs that fill the tables."""
