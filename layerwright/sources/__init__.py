"""Reading sources and landed feeds, writing layer tables."""
