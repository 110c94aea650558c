"""Readers of sequence, alignment, reference and profile files."""
