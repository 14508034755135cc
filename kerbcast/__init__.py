"""Spatiotemporal demand analytics as Spark DataFrame jobs.

Every operator takes and returns DataFrames; nothing here holds trip rows on the
driver.  ``sources`` reads and publishes tables, ``functions`` are column helpers,
``operators`` are the building blocks, ``plans`` chain them into whole jobs and
``streaming`` holds the Structured Streaming variants.
"""
