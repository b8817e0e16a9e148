"""Registered queries, each with the SQL it is compared against."""
