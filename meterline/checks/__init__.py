"""The queries that are compared with an independent SQL engine, and the inputs they read."""
