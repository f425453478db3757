"""Reading raw events, writing the feature store, keeping the feature catalogue."""
