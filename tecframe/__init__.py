"""Space-weather event tables on Spark: links, grids, swaths, index series."""

from tecframe.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
