"""DataFrame-to-DataFrame operators: bronze loads, dimensions, facts, posting, checks."""
