"""Typed readers for the source tables."""

from claimweave.sources.warehouse import Staging, Warehouse

__all__ = ["Staging", "Warehouse"]
