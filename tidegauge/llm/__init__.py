"""Operators for preparing language-model training data, by whole texts and at corpus scale."""
