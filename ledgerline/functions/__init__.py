"""Column-level helpers (JVM-side expressions only) and small distributed
building blocks: exact grouped quantiles, surrogate keys, checked broadcast."""
