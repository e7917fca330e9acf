"""streaming of shelfwise."""
