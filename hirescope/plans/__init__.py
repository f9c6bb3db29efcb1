"""Composed jobs: the batch preparation, the market view, regression and clustering flows."""
