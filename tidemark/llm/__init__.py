"""Operators for preparing large text collections, and the queries that apply them."""
