"""regiostat: regional statistics on Spark.

Star-schema ingest keyed to an administrative region hierarchy and a time
dimension, zonal statistics of raster pixels per region polygon, rollups up
the hierarchy, region-subset recomputes and published layer views -- all as
DataFrame plans that Catalyst optimises.
"""

__version__ = "0.1.0"
