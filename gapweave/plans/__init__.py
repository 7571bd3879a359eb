"""Jobs that chain operators, and the catalogue of checked queries."""
