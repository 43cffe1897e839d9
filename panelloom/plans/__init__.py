"""The survey on top of the generic operators: Silver, Gold, answers, chart tables."""
