"""Readers and writers for delimited text, panels, genotype text and fitted models."""
