"""Column-expression helpers; all compile to built-in Catalyst expressions."""
