"""Relational operators the plans are made of; each is exact on any distribution of keys."""
