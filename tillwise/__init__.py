"""Retail sales analytics and forecast monitoring as Spark DataFrame jobs."""
