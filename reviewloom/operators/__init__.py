"""DataFrame operators. ``scope`` names the columns that stand for one input file; empty means
the whole input is one file."""
