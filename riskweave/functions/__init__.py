"""Column-level building blocks: row-local, JVM-side, free of shuffles."""
