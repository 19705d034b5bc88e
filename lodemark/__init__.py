"""Model life cycle on Spark tables and streams: encode, split, train, score, label, compare, promote, watch."""
