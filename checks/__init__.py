"""The operators run on the shared test tables, each with an independent SQL result."""
