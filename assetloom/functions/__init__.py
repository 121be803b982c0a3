"""Column functions: JVM-side expressions used by the operators."""
