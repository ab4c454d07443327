"""Point-in-time feature engineering for game and match data on Spark."""
