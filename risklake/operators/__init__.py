"""Dataset operators: distributed rank, skew-safe join, staging."""
