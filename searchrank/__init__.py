"""searchrank: search-ranking analytics on Spark DataFrames.

Subpackages
-----------
sources    readers/writers and the search log derived from the driver tables
functions  column-level expressions: cleaning, labels
operators  DataFrame -> DataFrame operators: features, statistics, profiling,
           metrics, splits, partitions, submissions, pair tables
plans      model fitting/scoring/tuning jobs and the registered query catalog
"""

__version__ = "0.1.0"
