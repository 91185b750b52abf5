"""Column expressions and name helpers; all JVM-side."""
