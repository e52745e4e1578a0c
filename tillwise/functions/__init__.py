"""Column expressions shared by the operators, plans and streams."""
