"""Forecasters: (training rows tagged with fold_id, folds) -> quantile rows for the validation days."""
