"""Table operators: cleaning, filters, aggregates, inspection, features, models, evaluation."""
