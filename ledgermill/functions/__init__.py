"""Column-level helpers shared by every layer."""
