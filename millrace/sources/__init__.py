"""Readers for files, JSON text, generated rows and streams."""
