"""Composed plans over the driver tables (the reference's three flows)."""
