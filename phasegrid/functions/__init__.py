"""Column functions: complex algebra, geodesy, names and times."""
