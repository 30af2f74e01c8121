"""Column-to-Column functions; all evaluated in the JVM."""
