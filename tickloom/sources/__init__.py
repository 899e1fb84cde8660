"""Readers, payload normalisers and writers."""
