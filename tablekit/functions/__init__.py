"""Column-expression helpers (JVM-side, codegen friendly) and small UDFs."""
