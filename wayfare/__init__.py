"""Review analytics on Spark: parse, profile, balance, learn, score and rank."""
