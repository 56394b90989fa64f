"""Monthly-snapshot star schemas on PySpark.

``functions``  column expressions (codes, dates)
``operators``  DataFrame -> DataFrame building blocks
``sources``    reading, landing lists, writing, staging
``plans``      star tables, analytical queries, layers, synchronisation
``streaming``  Structured Streaming forms of landing and refresh
"""
