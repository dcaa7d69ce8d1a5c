"""Cross-source attention analytics for a catalogue of titles, built on Spark DataFrames."""
