"""Training-data operators: each module is one operator, ``queries`` holds
the catalog entries.  Nothing outside this package imports it."""
