"""DataFrame → DataFrame operators of the four jobs, plus skew-safe join/aggregate variants."""
