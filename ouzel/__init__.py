"""ouzel: distance outliers, k-center clustering and frequent items on Spark.

Every operator takes and returns DataFrames. Points are DataFrames with
columns ``id bigint, x double, y double``; item streams have
``seq bigint, item bigint``.
"""

from ouzel.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
