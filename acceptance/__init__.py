"""Acceptance queries over the driver's tables, and the SQL that says what each must return."""
