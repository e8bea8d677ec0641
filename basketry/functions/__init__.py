"""Building blocks shared by the operators."""
