"""Catalogue and gridding of geospatial layers as Spark DataFrame operators."""

from shoalgrid.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
