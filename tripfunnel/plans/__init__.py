"""Models composed from the operators: marts, recommendations, rule sets, the full run."""
