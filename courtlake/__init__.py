"""Medallion pipelines (raw documents -> typed tables -> star schema) as Spark DataFrame jobs."""
