"""Column functions: text cleanup, instants, money and lists. All stay in the JVM."""
