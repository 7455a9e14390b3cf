"""Learning on the feature table: preparation, split, training, evaluation, scoring."""
