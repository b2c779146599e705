"""tabml: distributed tabular binary-classification analytics on Spark.

Every operator takes and returns DataFrames; the work runs on executors and
plans stay lazy unless an operator is a *fit* (which, like an MLlib
``Estimator.fit``, runs jobs and returns a small set of learned parameters).
"""

from tabml.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
