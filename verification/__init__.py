"""The library's queries over the provided test tables, and the same results in plain SQL."""
