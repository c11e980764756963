"""Column-expression helpers shared by the operators (classes, flags, minutes, ratios, day ranges)."""
