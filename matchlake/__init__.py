"""Match analytics on Spark: landed JSON -> Bronze -> Silver -> Gold -> metrics."""

from matchlake.session import configure, scratch_dir

__all__ = ["configure", "scratch_dir"]
