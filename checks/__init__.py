"""Registered queries, one per operator, each next to the SQL it must agree with."""
