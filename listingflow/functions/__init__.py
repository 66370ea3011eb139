"""Column -> Column helpers; all stay inside generated JVM code."""
