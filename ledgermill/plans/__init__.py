"""Report tables, serving queries and the full build, composed from the operators."""
