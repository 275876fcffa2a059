"""reelrank: recommender analytics (statistics, ALS, item similarity, real-time
recommendations, log and rating streams) as Spark DataFrame jobs."""

__version__ = "0.1.0"
