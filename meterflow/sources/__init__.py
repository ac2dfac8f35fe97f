"""Readers for streams and files."""
