"""Federated tables, JSON documents and row history as PySpark DataFrame jobs."""
