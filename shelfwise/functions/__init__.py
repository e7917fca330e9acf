"""functions of shelfwise."""
