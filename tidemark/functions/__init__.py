"""Column expressions. All are Catalyst built-ins, none is a Python UDF."""
