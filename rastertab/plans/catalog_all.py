"""Imports every query module so that the registry is complete."""

from rastertab.plans import derived_queries, job_queries, raster_queries, relational_queries, table_queries  # noqa: F401
