"""Column expressions. Each function takes and returns ``Column`` and stays in the JVM."""
