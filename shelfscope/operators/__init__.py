"""Relational building blocks and payload flatteners."""
