"""Column functions: text, dates, identifiers, nested values.  All stay on the JVM."""
