"""Business reports of an online wholesale shop as Spark DataFrames."""
