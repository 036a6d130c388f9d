"""Queries over the tables, by family, each with the SQL it is held against."""
