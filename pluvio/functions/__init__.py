"""Column functions: geodesy, rain rate, colours, time."""
