"""Readers, writers and adapters. Only this package and the storage helpers touch files."""
