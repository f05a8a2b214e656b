"""Readers and writers of the layer tables and the warehouse."""
