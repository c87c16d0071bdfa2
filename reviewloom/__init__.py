"""Product-review analytics as ordinary Spark plans."""
