"""Ready reports on the review tables, as DataFrames and as SQL, and plan inspection."""
