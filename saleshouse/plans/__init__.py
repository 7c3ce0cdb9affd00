"""The warehouse layers and every report over them, as functions from DataFrames to DataFrames."""
