"""Fitted plans: the feature estimator, model pipelines and the training run."""
