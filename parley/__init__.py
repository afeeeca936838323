"""Conversation timeline analytics and corpus preparation on Spark DataFrames."""
