"""Column helpers; all stay inside built-in expressions."""
