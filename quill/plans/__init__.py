"""The reports: compositions of sources, functions and operators."""
