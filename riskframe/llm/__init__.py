"""Training-data operators: scoring, cleaning, mixing and formatting of text."""
