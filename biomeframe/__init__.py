"""Metagenomics analytics on Spark."""
