"""Registered queries, their input projections and their SQL counterparts."""
