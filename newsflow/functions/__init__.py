"""Column functions: row-local, JVM-side, usable in batch and in streams alike."""
