"""quernwork: corpus building and analysis on Spark DataFrames."""
