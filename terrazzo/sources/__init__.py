"""Readers and writers of pixel, legend, word and manifest tables."""
