"""The registered queries over the given tables, with their SQL counterparts."""
