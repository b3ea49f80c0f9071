"""Column functions (``Column -> Column``), all JVM-side built-ins."""
