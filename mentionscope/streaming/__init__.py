"""mentionscope.streaming."""
