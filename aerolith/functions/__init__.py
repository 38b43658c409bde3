"""Column-expression builders (JVM-side, codegen friendly) and their SQL twins."""
