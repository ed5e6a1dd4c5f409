"""The operators bound to the provided tables, and the same results in SQL."""
