"""ledgerline: commission, extract and report-dataset jobs on Spark DataFrames."""
