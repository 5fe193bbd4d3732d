"""Driver queries: the library's operators over the driver's tables, and their SQL twins."""
