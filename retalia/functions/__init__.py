"""Column expressions: ``Column -> Column``, JVM-side only."""
