"""Readers and writers, and the mapping from the driver's tables to the domain tables."""
