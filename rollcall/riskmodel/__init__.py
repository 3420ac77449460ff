"""Attrition risk: features, model, metrics, scores, explanations."""
