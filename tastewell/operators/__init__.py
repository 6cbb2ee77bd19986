"""DataFrame operators: statistics, content model, factorisation, hybrid, reports."""
