"""Vessel-risk analytics on Spark: position reports in, risk scores and routing advice out."""
