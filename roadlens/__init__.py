"""roadlens: road-incident and detection-log analytics on Spark DataFrames.

Every public function takes and returns DataFrames (or Columns), builds a
lazy plan, and leaves execution to Catalyst. Eager steps are limited to the
sinks, K-means fitting, the chunk-parallel tracker's stitching rounds, and
checkpoints of small pre-aggregates (``session.cut_lineage``) that later
steps read more than once.
"""

__version__ = "0.1.0"
