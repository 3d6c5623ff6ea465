"""mentionscope.plans."""
