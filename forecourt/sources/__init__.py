"""Readers, writers and the input views."""
