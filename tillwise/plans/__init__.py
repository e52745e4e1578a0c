"""Standing views, reports and the registry of runnable queries."""
