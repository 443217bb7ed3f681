"""Workforce analytics on Spark: staging files to a star schema with dated employee versions, and the questions asked of it."""
