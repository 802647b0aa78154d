"""Column helpers: keys, exact rounding, fixed business labels."""
