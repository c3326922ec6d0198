"""Article-stream analytics as plain DataFrame and Structured Streaming code.

``sources``    directories, message streams and poll responses as DataFrames
``functions``  column expressions: JSON, event time, sentence templates
``operators``  DataFrame -> DataFrame steps: cleaning, counting, rollups, retrieval
``streaming``  sinks, fan-out and incremental refresh for streaming queries
``plans``      the flows built from those parts, end to end
"""
