"""siftspark: refine archives of semi-structured experiment files into typed tables on Spark."""

from siftspark.registry import Category, Column, Registry, default_registry

__all__ = ["Category", "Column", "Registry", "default_registry"]
