"""DataFrame -> DataFrame operators: term lists, weights, scores, candidates, reports."""
