"""operators of shelfwise."""
