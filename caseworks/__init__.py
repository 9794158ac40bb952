"""caseworks: case analytics and multi-target classification as Spark jobs."""

from caseworks.session import build_session, checkpoint_folder

__all__ = ["build_session", "checkpoint_folder"]
