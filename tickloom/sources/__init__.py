"""Readers: topics, the trade feed, klines and archives."""
