"""Curation and analysis of agent trajectories as Spark DataFrame plans."""

__version__ = "0.1.0"
