"""Marketplace price and buy-box analytics expressed as Spark plans."""
