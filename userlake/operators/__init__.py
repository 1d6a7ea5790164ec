"""DataFrame-to-DataFrame steps: lazy, no action inside."""
