"""Operators for preparing training text at scale, each built by one named method."""
