"""mentionscope.operators."""
