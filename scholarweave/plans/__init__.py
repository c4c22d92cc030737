"""End-to-end record plans and the catalogue of queries over the driver tables."""
