"""Audience analytics for a video service, written for PySpark DataFrames.

Sub-packages
------------
``sources``    scans, declared schemas, schema merge, access-log parsing, sinks
``functions``  column expressions (paths, scalars, labels, network addresses)
``operators``  lazy DataFrame -> DataFrame operators (counts, retention, ...)
``streaming``  the counters that also run on Structured Streaming
``plans``      the daily reports, each a parameter set of the operators
"""

__version__ = "0.1.0"
