"""Dataset-pipeline operators on DataFrames."""
