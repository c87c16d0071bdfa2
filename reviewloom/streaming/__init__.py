"""Reviews that are still arriving."""
