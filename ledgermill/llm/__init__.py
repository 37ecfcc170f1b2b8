"""Operators for preparing training text: counting, packing, mixing, sharding, cleaning and scoring documents."""
