"""DataFrame -> DataFrame operators, grouped by kind (inventory rows 10-65)."""
