"""Registered queries by family, with their SQL."""

FAMILIES = ["corpus", "labelling", "evaluation", "experiments", "requests", "reports", "vectors"]
