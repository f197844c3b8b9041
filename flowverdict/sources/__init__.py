"""Readers, catalogs, stored models and writers."""
