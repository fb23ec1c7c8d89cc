"""Model graph and pipeline runs."""

from tillbook.plans.graph import MODEL_NAMES, Project

__all__ = ["MODEL_NAMES", "Project"]
