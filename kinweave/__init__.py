"""A PySpark engine for person registries and kinship networks."""
