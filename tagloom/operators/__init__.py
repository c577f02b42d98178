"""Facts (one row per order, visit, view, ...) and the metrics aggregated from them."""
