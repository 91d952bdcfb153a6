"""maskframe: Spark-native analytics over run-length masks, annotations, image grids and scores.

Masks are tables of runs ``(image_id, start0, len)`` on a column-major flat index; every public operator takes and
returns DataFrames so Catalyst plans the whole lineage.
"""

from maskframe.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
