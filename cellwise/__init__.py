"""cellwise: battery / charging analytics as Spark DataFrame operators.

Every operator is a function from DataFrame(s) to a DataFrame (fit functions
return a small DataFrame or a fitted ``PipelineModel``), so they chain with
``df.transform``.  All heavy work runs as Spark jobs; the driver only ever
holds bounded summaries (dictionaries, bucket boundaries, metric rows).
"""

from cellwise.session import get_spark, scratch_path

__all__ = ["get_spark", "scratch_path"]
