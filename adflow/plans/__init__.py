"""Registered queries: each runs an operator over whole tables, with the SQL it must agree with."""
