"""Column-level expression builders (all JVM built-ins, no Python UDFs)."""
