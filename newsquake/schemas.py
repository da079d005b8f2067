"""Schemas of stored rows; keys that do not apply hold an empty string."""

from pyspark.sql import types as T

ROW_FIELDS = (
    "task", "ticker", "user_query", "price_context", "market_data", "valuation", "earnings",
    "news", "news_reaction", "recommendation", "valuation_bucket", "output",
)
ROW = T.StructType([T.StructField(name, T.StringType()) for name in ROW_FIELDS])

OLD_OUTPUT = "struct<impacted_stocks: array<struct<recommendation: string, reasoning: string, answer: string>>>"
