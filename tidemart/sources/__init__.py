"""Readers: tables, JDBC relations, event streams and queries across several of them."""
