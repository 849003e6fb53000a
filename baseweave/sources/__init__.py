"""Readers and writers of delimited genomic text."""
