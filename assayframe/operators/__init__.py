"""DataFrame operators: checks, report, row ids, lookups, windows, repair, injection."""
