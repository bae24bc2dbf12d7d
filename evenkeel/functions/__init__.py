"""Column expressions; all of them stay in the JVM except ``names.sequence_ratio``."""
