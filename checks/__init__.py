"""Registered queries, the messy tables they run on, and their SQL counterparts."""
