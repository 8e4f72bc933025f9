"""Readers and writers: corpus, folds, predictions, metrics, runs, exemplars, templates, tables."""
