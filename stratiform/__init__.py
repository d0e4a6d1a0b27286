"""Layered tables on Spark: ingest, refine, model, and check them as DataFrame jobs."""

from stratiform.spec import Column_, Contract, Entity, Policy, Request, Rule

__all__ = ["Column_", "Contract", "Entity", "Policy", "Request", "Rule"]
