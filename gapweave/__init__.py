"""Gap-free meteorological series from patchy sensor records, on Spark.

Layers, from the bottom up:

``functions``  Column expressions (clock, moisture, null rules)
``sources``    file layouts, name maps, readers and writers
``operators``  DataFrame -> DataFrame building blocks
``plans``      jobs that chain operators, and the query catalogue
"""

from gapweave.session import local_session, shared_folder

__all__ = ["local_session", "shared_folder"]
