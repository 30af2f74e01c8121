"""Readers, writers and working folders."""
