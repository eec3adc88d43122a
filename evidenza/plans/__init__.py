"""End-to-end compositions of the operators, and the catalogue of checked queries."""
