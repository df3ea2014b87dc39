"""Mediation, rating and billing of usage records as Spark jobs.

Every operator is a function from DataFrame to DataFrame.  It opens no session, reads no clock and performs
no I/O of its own, so batch jobs, Structured Streaming and tests share it.
"""
