"""Multi-step plans: preparation, scoring, training, evaluation."""
