"""Column-level functions (P-series): all JVM-side built-in expressions."""
