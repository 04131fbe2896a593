"""Text analytics for English and Arabic corpora as Spark DataFrames."""
