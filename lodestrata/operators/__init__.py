"""DataFrame operators: contracts, rules, de-duplication, gaps, periods, checks."""
