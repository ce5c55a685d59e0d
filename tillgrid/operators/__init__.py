"""DataFrame-to-DataFrame report operators."""
