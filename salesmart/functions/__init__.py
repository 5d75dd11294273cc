"""Column expressions shared by the operators (money, calendar attributes)."""
