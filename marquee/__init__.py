"""marquee: media-catalog cleaning, star schema, profiling and recommendations on Spark."""
