"""Archives, file lists and stored tables as DataFrames."""
