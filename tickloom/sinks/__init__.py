"""Writers: the candle table and the tick topic."""
