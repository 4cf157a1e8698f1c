"""Named analytics: ratings (N1-N5, N14-N20), reviews (N6-N13), commerce."""
