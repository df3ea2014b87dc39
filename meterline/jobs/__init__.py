"""Command line jobs, to be run with spark-submit."""
