"""Company-registry analytics as plain PySpark jobs.

``functions``  column expressions (dates, codes, money, regions, formats)
``operators``  DataFrame in, DataFrame out; no operator runs a job
``sources``    layouts, archives, delimited files, links, geometry
``plans``      jobs built from the above: ingest, publish, products
``streaming``  incremental archive intake
"""
