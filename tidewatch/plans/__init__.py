"""Table builders: cleaned, enriched and star tables composed of the operators."""
