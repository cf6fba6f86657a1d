"""Keyword index and boolean document search, built on Spark DataFrames.

Index state is never held in Python objects: every operator takes and returns
DataFrames, so Catalyst plans the work and the cluster holds the data.
"""

from lexisieve.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
