"""Jobs made of operators, and the queries over the driver's tables."""
