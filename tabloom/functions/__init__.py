"""Pure column builders: they take columns and return columns, and never touch data."""
