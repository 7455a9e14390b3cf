"""Column helpers: expressions only, all evaluated inside the JVM."""
