"""Modelling, quality and reporting jobs for keyed event data, on Spark DataFrames."""

from tidemark.session import build_session, scratch_path, shared_dir

__all__ = ["build_session", "scratch_path", "shared_dir"]
