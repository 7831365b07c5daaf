"""Column expressions.  Everything here is built from JVM functions, no UDFs."""
