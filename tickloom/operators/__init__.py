"""DataFrame operators: candles, gap fill, lateness, readiness, subscriptions, catalog."""
