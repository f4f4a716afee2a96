"""Pickup planning on Spark: siting, assigning and serving passenger stops."""
