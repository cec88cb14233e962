"""Column expressions: pure functions Column -> Column, JVM-side unless noted."""
