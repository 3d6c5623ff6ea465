"""mentionscope.sources."""
