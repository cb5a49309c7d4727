"""Silver cleaners, gold marts, and the registered queries over the
benchmark tables."""
