"""Reading raw CSV tables, landing them, and writing the warehouse."""
