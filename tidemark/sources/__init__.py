"""Reading, staging, publishing and updating tables."""
