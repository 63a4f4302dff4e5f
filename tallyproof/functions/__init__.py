"""Functions of the engine, each lazily composed from DataFrames and columns."""
