"""DataFrame -> DataFrame building blocks; no actions unless a docstring says so."""
