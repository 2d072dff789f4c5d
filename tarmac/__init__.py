"""Flight-delay analytics on Spark: cleaning, leaderboards, features, models."""
