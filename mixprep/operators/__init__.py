"""DataFrame -> DataFrame operators (normalise, filter, look up, generate, sample, profile, encode)."""
