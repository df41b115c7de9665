"""pitwall: motor-racing lap analytics on Spark DataFrames.

Layers:
  sources/    readers, sinks, the fixture lap/weather views, model store
  functions/  column expressions (time parsing, flags, row-wise min)
  operators/  DataFrame -> DataFrame building blocks (aggregates, joins, ranks)
  plans/      composed jobs: collection, driver-race features, training, inference
  streaming/  incremental session collection with Structured Streaming
"""

from pitwall.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
