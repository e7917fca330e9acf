"""plans of shelfwise."""
