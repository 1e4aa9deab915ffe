"""Column factories; all of them stay inside the JVM."""
