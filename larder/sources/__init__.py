"""Readers, writers and the shared-folder staging used between jobs."""
