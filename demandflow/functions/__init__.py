"""Column expressions (JVM-side, codegen-friendly): time, geohash, interactions."""
