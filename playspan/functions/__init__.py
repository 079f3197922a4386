"""Column expressions used inside the jobs. Built-in functions only."""
