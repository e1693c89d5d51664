"""Two-source business-data fusion and claim-risk scoring on Spark.

Every operator maps DataFrames to DataFrames and leaves execution to Spark. Paths and sessions appear
only in ``sources``, ``streaming`` and ``session``.
"""
