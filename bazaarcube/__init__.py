"""Retail star schema and OLAP cubes expressed as Spark jobs."""
