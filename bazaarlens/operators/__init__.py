"""Building blocks: joins that bear skew, rollups, top-k and quality profiles."""
