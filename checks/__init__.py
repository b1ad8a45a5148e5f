"""Registered queries with their SQL counterparts, for the driver, tests and bench."""
