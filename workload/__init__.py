"""The library's queries on the driver's tables, with their SQL counterparts."""
