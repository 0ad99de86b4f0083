"""Readers, writers and analog views."""
