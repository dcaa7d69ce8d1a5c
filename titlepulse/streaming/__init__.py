"""Incremental reading of the landing folder."""
