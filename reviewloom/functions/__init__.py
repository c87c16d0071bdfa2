"""Column functions. None of them leaves the JVM."""
