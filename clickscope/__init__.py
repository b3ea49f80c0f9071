"""clickscope: user-behaviour analytics (sessions, page flow, area top products, ad clicks) on Spark SQL.

Every operator is a plain ``DataFrame -> DataFrame`` function built from ``pyspark.sql.functions``;
composed jobs live in :mod:`clickscope.plans`, the ad-click stream in :mod:`clickscope.streaming`.
"""

__all__ = ["config", "params", "schemas"]
