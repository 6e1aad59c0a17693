"""DataFrame-in, DataFrame-out operators, grouped by the reference's areas."""
