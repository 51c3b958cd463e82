"""The 23 models, their data tests and the daily refresh."""
