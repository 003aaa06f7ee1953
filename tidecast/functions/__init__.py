"""Column-expression helpers shared by all operators (JVM-side, codegen'd)."""
