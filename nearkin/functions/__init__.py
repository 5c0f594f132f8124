"""Column functions used inside the table jobs."""
