"""pricewh: a market-price warehouse on Spark DataFrames.

Every operator takes DataFrames and returns a lazily planned DataFrame that
covers *all* assets in one job; callers filter afterwards.  Nothing is
collected inside an operator.
"""

__version__ = "0.1.0"
