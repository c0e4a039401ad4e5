"""DataFrame operators: examples, vocabulary, metrics, checkpoints, registry."""
