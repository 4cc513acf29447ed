"""Where results go: appended tables, keyed tables built from batches, replaced groups."""
