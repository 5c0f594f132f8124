"""Multi-operator jobs: preparation, search, training, deep evaluation."""
