"""Spark-native analysis of mobility and crowd activity around a city event."""

from plazaflow.config import EventConfig, build_session, scratch_dir

__all__ = ["EventConfig", "build_session", "scratch_dir"]
