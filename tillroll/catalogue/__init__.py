"""Registered queries: each pairs a Spark program with an independent SQL statement."""
