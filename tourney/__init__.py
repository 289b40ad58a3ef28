"""Analytics over recorded rounds of repeated two-player games, as PySpark DataFrame functions."""
