"""Rating analytics and prediction on Spark.

Every operator takes DataFrames plus column names and returns a lazy
DataFrame; only tuned scalars (a mean, a best lambda, a handful of
quantile breaks) and the small k x k matrices of the SVD ever come back
to the driver.
"""

from ratingspark.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
