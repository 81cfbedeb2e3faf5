"""The dimension, fact and report plans."""
