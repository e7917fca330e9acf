"""sources of shelfwise."""
