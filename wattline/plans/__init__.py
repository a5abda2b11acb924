"""Jobs that chain operators, and the catalogue of queries over the driver's tables."""
