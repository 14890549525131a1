"""rillet: batch and streaming sequence analytics on PySpark.

Every operator is a function ``DataFrame -> DataFrame`` built from the
DataFrame API, so Catalyst plans it and the same code serves
``spark.read`` and (where the semantics allow) ``spark.readStream`` input.
"""

from rillet.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
