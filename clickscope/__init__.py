"""clickscope: e-commerce clickstream analytics on Spark DataFrames.

Batch questions (category ranking, top sessions, page conversion) and
ad-click stream questions (running counts, top-3 ads, click blacklist)
expressed with the DataFrame API, Spark SQL and Structured Streaming.
"""

__version__ = "0.1.0"
