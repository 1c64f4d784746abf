"""sedimenta: evidence-based data curation and analytics on Spark DataFrames."""
