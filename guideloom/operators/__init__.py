"""Sequence, target, site, specificity, efficiency, result and acquisition operators."""
