"""Binds the generated test tables to the library's inputs, and states each query again for the SQL check."""
