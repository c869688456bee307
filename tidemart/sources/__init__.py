"""Readers, writers and connector settings."""
