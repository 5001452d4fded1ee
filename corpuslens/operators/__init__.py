"""DataFrame-to-DataFrame operators of the four jobs."""
