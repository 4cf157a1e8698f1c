"""Materialising an intermediate shared by several outputs.

On a cluster the checkpoint goes to the shared folder the cluster names in
``spark.checkpoint.dir`` (an error if none is set).  A reliable checkpoint
survives executor loss and cuts the lineage, unlike a cache.
"""

from quarry.session import materialize

__all__ = ["materialize"]
